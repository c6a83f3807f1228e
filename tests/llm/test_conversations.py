import hashlib
import random
import re
import zlib
from collections import defaultdict
from functools import lru_cache

import pytest

from tristar.llm.conversations import align, damage, folded, op13, repair, repaired_turns, weave

SF = "/root/testdata/sf0.001"
WS = " \t\n\x0b\x0c\r"
COLS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def least(rows):
    """(cost, audit) by recursion over all edits; ``rows``: (initial, fault)."""
    @lru_cache(None)
    def best(i, done, budget):
        """From turn i on with the grammar's state ``done``, at most ``budget`` insertions."""
        out = []
        if i == len(rows) and done in ("", "a"):
            out.append((0, ""))
        nexts = {"": "su", "s": "u", "u": "a", "a": "u"}[done]
        if i < len(rows):
            initial, fault = rows[i]
            c, a = best(i + 1, done, budget)
            out.append((c + 2, "D" + a))
            if fault not in ("b", "d"):
                more = 5 if fault == "t" else 0
                for t in nexts:
                    c, a = best(i + 1, t, budget)
                    if initial == t:
                        out.append((c + more, "K" + a))
                    if t != "s":
                        out.append((c + 1 + more, "R" + a))
        if budget:
            for t in nexts.replace("s", ""):
                c, a = best(i, t, budget - 1)
                out.append((c + 5, "I" + a))
        return min(out, default=(10 ** 9, ""))
    return best(0, "", 3)


def brute(table):
    """The contract on plain rows (conv_id, turn, role, text)."""
    convs = defaultdict(list)
    for conv, turn, role, text in table:
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        convs[conv] += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    out = {}
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        faults, seen = [], set()
        for _, role, text in rows:
            faults.append("b" if not text.strip(WS) else "d" if (role, text) in seen
                          else "" if text.strip(WS)[-1] in ".!?" else "t")
            seen.add((role, text))
        cost, audit = least(tuple((r[1][:1], f) for r, f in zip(rows, faults)))
        lines, left, kept = [], iter(rows), sum(c != "D" for c in audit)
        target = "s" * (kept % 2) + "ua" * (kept // 2)
        for c in audit:
            r = next(left) if c != "I" else (None, "", "")
            if c != "D":
                t, target = target[0], target[1:]
                lines.append(f"{r[1] if c == 'K' else {'u': 'user', 'a': 'assistant'}[t]}:{r[2]}")
        known = [r[0] for r in rows if r[0] is not None]
        first = [r[1][:1] for r in rows]
        out[conv] = (max(known) - min(known) + 1 - len(set(known)) if known else 0,
                     faults.count("b"), faults.count("d"), faults.count("t"),
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:])),
                     cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def found(df):
    rows = df.collect()
    out = {r["conv_id"]: tuple(r[c] for c in COLS) for r in rows}
    assert len(out) == len(rows)
    return out


def test_alignment_equals_all_scripts():
    rng = random.Random(5)
    for _ in range(1500):
        n = rng.randint(0, 9)
        rows = tuple((rng.choice("suao"), rng.choice(["", "", "", "t", "b", "d"])) for _ in range(n))
        letters = "".join("x" if f in ("b", "d") else r.upper() if f else r for r, f in rows)
        assert weave(letters) == weave(letters, folded) == least(rows)


def test_bands_widen_until_they_suffice():
    rng = random.Random(6)
    for n in (40, 120, 300):
        for kinds in ("ua", "uuua", "suao", "u", "o"):
            roles = "".join(rng.choice(kinds) for _ in range(n))
            cut = "".join(rng.choice("0001") for _ in range(n))
            assert align(roles, cut) == folded(roles, cut)


CASES = [
    (1, 0, "system", "Be kind."), (1, 1, "user", "Hi there."), (1, 2, "assistant", "Yes"),
    (1, 3, "user", " \t"), (1, 3, "assistant", "Tie."), (1, 9, "assistant", "Tie."),
    (2, None, "user", "No turn."), (2, None, "user", "No turn."), (2, 5, None, "Role?"),
    (3, 1, "tool", None), (3, 2, "", "End!"), (None, 4, "user", "a."), (None, 5, "assistant", "b."),
    (4, None, None, None), (5, 7, "user", "x" * 200_000 + "."), (5, 8, "assistant", "é…? "),
    *[(6, t, ["user", "assistant"][t % 2], f"Turn {t // 3}.") for t in range(90)],
    *[(7, t, "assistant", "same.") for t in range(30)],
    *[(c, 0, "user", "dropped?") for c in range(100, 160)],
]
TYPE = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("rows,size", [(2048, 1 << 25), (0, 1 << 25), (25, 1 << 16)])
def test_equals_brute_force_in_both_ways(spark, rows, size):
    df = spark.createDataFrame(CASES, TYPE)
    assert found(repair(damage(df), rows, size)) == brute(CASES)


def test_repaired_turns_are_what_was_digested(spark):
    df = damage(spark.createDataFrame(CASES, TYPE))
    for rows in (2048, 0):
        lines = defaultdict(list)
        for r in sorted(repaired_turns(df, rows).collect(), key=lambda r: (r["place"], r["sub"])):
            lines[r["conv_id"]].append(f"{r['role']}:{r['text']}")
        for conv, want in brute(CASES).items():
            assert hashlib.sha256("\n".join(lines[conv]).encode()).hexdigest() == want[-1]


def test_query_on_whole_table(spark):
    table = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet")
             .select("conv_id", "turn", "role", "text").collect()]
    assert found(op13(spark, SF)) == brute(table)


def test_empty_table_and_extra_columns(spark):
    df = spark.createDataFrame([(1, 1, "user", "a.", 5, "z")],
                               TYPE + ", copies int, _kind string")
    assert found(repair(damage(df.limit(0)))) == {}
    assert found(repair(damage(df))) == brute([(1, 1, "user", "a.")])
