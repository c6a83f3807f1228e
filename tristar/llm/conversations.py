"""Conversation structure repair by Wagner-Fischer target alignment.

A well-formed conversation is ``(s?(ua)+)?``: perhaps a system turn, then user and assistant in
turn. For each length there is just one such string, so repairing means aligning the turns
with the target of each feasible length and keeping the cheapest script of edits (K keep 0,
R rerole 1, D delete 2, I insert 5; keeping a truncated turn costs 5 more; blank and repeated
turns must go).

* All even targets are suffixes of one string ``...uaua``, and odd ones only add a first ``s``,
  so one Wagner-Fischer table of (turns left, target characters left) serves every length.
* Only an *Ukkonen band* of it is filled: a script within the incumbent cost U deletes at most
  U / 2 turns and inserts at most (U - 2 * truncated) / 5, so cells further from the diagonal
  cannot matter. The incumbent comes from a narrow band, which is widened until it suffices.
* For each length of the least cost the script is traced back from the front, taking the
  ASCII-least edit that stays optimal; the least of these audits wins.

Spark deals conversations out by id and sorts their turns; a task streams through them and
holds one at a time. A conversation of over ``ROWS`` turns or ``BYTES`` bytes takes
another, exact way (``_long``): its turns are numbered over range partitions, repeats are
found by an aggregation, only one letter a turn comes together (like the audit, which is one
cell of the result) and is aligned by a table folded to the four states of the grammar,
and the edits are joined back to the turns. Only its digest, which is sequential by
definition, is computed by one task that streams the repaired turns.

Defined results: null roles and texts are one space, a null turn sorts first, a null conv_id is
a conversation of its own; turns tied on ``turn`` stand by role, then text; repeated rows count
as repeated turns; very long texts are read whole; an empty table gives no rows; extra
columns are not read.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tristar.session import write_stage

ROWS, BYTES = 2048, 32 << 20    # beyond these a conversation takes the distributed way
BLOCK = 1024
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
FAR = 1 << 28
WHITE = " \t\n\x0b\x0c\r"       # fixed value: [\x20\x09-\x0D]
LEGAL = {"su", "ua", "au"}
ROLE = {"u": "user", "a": "assistant"}
STATS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
SHORT_OUT = (f"conv_id long, {STATS}, audit string, "
             "turns array<struct<edit:string,role:string,text:string>>")


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and ``copies`` (0: dropped, 2: repeated adjacently) of every row,
    damaged by a checksum of ``conv_id:turn``."""
    blank = F.lit(" ")
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), blank).alias("role"),
        F.coalesce(F.col("text").cast("string"), blank).alias("text"))
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"),
                    F.coalesce(F.col("turn").cast("string"), blank))
    rows = rows.withColumn("_kind", F.crc32(name.cast("binary")) % 20)
    return rows.select(
        "conv_id", "turn", F.when(F.col("_kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("_kind") <= 1, "").when(F.col("_kind") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text")).alias("text"),
        F.when(F.col("_kind") == 0, 0).when(F.col("_kind") == 3, 2).otherwise(1).alias("copies"))


def _suffixes(initials: str, cut: np.ndarray, down: int, up: int) -> np.ndarray:
    """Cost of aligning the turns from i on with the last r characters of ``...uaua``, as
    table[i, r]; outside the band of ``down`` deletions and ``up`` insertions FAR."""
    m = len(initials)
    table = np.full((m + 1, m + up + 1), FAR, np.int32)
    table[m, :up + 1] = INSERT * np.arange(up + 1)
    for i in range(m - 1, -1, -1):
        low, high = max(0, m - i - down), m - i + up
        r = np.arange(low, high + 1, dtype=np.int32)
        best = table[i + 1, low:high + 1] + DELETE
        wanted = np.where(r % 2 == 1, initials[i] != "a", initials[i] != "u") * REROLE
        first = 1 if low == 0 else 0
        kept = table[i + 1, low - 1 + first:high] + wanted[first:] + TRUNCATED * cut[i]
        np.minimum(best[first:], kept, out=best[first:])
        # Insertions run along the row: a running minimum without their cost.
        table[i, low:high + 1] = np.minimum(
            np.minimum.accumulate(best - INSERT * r) + INSERT * r, FAR)
    return table


def _lengths(initials: str, cut: np.ndarray, table: np.ndarray) -> dict[int, int]:
    """{target length: cost} of all feasible lengths in the band."""
    out = {r: int(c) for r, c in enumerate(table[0]) if r % 2 == 0 and c < FAR}
    for gone, role in enumerate(initials):   # odd: the turns before a kept system turn go
        if role == "s":
            ahead = DELETE * gone + TRUNCATED * int(cut[gone])
            for r, c in enumerate(table[gone + 1]):
                if r and r % 2 == 0 and c < FAR:
                    out[r + 1] = min(out.get(r + 1, FAR), int(c) + ahead)
    return out


def _trace(initials: str, cut: np.ndarray, table: np.ndarray, length: int, cost: int) -> str:
    """The ASCII-least script of that cost onto the target of that length."""
    m, i, r, out = len(initials), 0, length, []
    if length % 2:
        # Deleting is least, so the system turn that is kept is the last that costs no more.
        i = max(k for k, role in enumerate(initials) if role == "s" and
                table[k + 1, length - 1] + DELETE * k + TRUNCATED * cut[k] == cost)
        out, i, r = ["D"] * i + ["K"], i + 1, length - 1
    while i < m or r:
        now = table[i, r]
        if i < m and table[i + 1, r] + DELETE == now:
            out.append("D")
            i += 1
        elif r and table[i, r - 1] + INSERT == now:
            out.append("I")
            r -= 1
        else:
            out.append("K" if initials[i] == ("a" if r % 2 else "u") else "R")
            i, r = i + 1, r - 1
    return "".join(out)


def align(initials: str, truncated: str) -> tuple[int, str]:
    """(cost, audit) of turns none of which must go. ``truncated``: one "1" or "0" a turn."""
    m, cut = len(initials), np.array([t == "1" for t in truncated], np.int32)
    down, up = min(4, m), 2
    while True:
        table = _suffixes(initials, cut, down, up)
        costs = _lengths(initials, cut, table)
        least = min(costs.values())
        need = min(m, least // DELETE), (least - DELETE * int(cut.sum())) // INSERT
        if down >= need[0] and up >= need[1]:
            break
        down, up = min(max(2 * down, 1), max(need[0], down)), min(2 * up, max(need[1], up))
    return least, min(_trace(initials, cut, table, n, c) for n, c in costs.items() if c == least)


_known = lru_cache(1 << 16)(align)


def weave(letters: str, aligned=None) -> tuple[int, str]:
    """(cost, audit) of all turns. ``letters``: "x" for a turn that must go, else the initial
    (s, u, a, or o for others), upper-case if the turn is truncated. A turn that must go is
    deleted before anything is inserted there, as D comes before I."""
    free = [c for c in letters if c != "x"]
    aligned = aligned or (_known if len(free) <= 64 else align)
    cost, audit = aligned("".join(free).lower(), "".join("01"[c.isupper()] for c in free))
    out, at = [], 0
    for c in letters:
        if c == "x":
            out.append("D")
            continue
        end = at
        while audit[end] == "I":
            end += 1
        out.append(audit[at:end + 1])
        at = end + 1
    return cost + DELETE * (len(letters) - len(free)), "".join(out) + audit[at:]


def folded(initials: str, truncated: str) -> tuple[int, str]:
    """As ``align``, by a table over the grammar's states (0 start, 1 after s, 2 after u, 3
    after a) in place of target lengths: linear in the turns."""
    m, goes = len(initials), {"u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}, "s": {0: 1}}
    insert = (2, 2, 3, 2)
    cost = np.empty((m + 1, 4), np.int64)
    cost[m] = 0, 2 * INSERT, INSERT, 0
    for i in range(m - 1, -1, -1):
        after, here = cost[i + 1].tolist(), []
        extra = TRUNCATED * (truncated[i] == "1")
        for q in range(4):
            step = after[q] + DELETE
            step = min(step, after[insert[q]] + REROLE + extra)
            to = goes.get(initials[i], {}).get(q)
            here.append(step if to is None else min(step, after[to] + extra))
        for q in (2, 3, 2, 0, 1):
            here[q] = min(here[q], here[insert[q]] + INSERT)
        cost[i] = here
    table, i, q, out = cost.tolist(), 0, 0, []
    while i < m or q not in (0, 3):
        now = table[i][q]
        extra = TRUNCATED * (i < m and truncated[i] == "1")
        to = goes.get(initials[i], {}).get(q) if i < m else None
        if i < m and table[i + 1][q] + DELETE == now:
            out.append("D")
            i += 1
        elif table[i][insert[q]] + INSERT == now:
            out.append("I")
            q = insert[q]
        elif to is not None and table[i + 1][to] + extra == now:
            out.append("K")
            i, q = i + 1, to
        else:
            out.append("R")
            i, q = i + 1, insert[q]
    return int(cost[0, 0]), "".join(out)


def targets(audit: str, odd: bool):
    """(edit, target initial) of each edit: the target alternates, after a kept system turn."""
    k = -1 if odd else 0
    for edit in audit:
        if edit == "D":
            yield edit, ""
        else:
            yield edit, "s" if k < 0 else "ua"[k % 2]
            k += 1


def _odd(audit: str) -> bool:
    return (len(audit) - audit.count("D")) % 2 == 1


def _fault(text: str) -> str:
    """"b" blank, "t" truncated or "" (repeats are found by the caller)."""
    end = text.rstrip(WHITE)
    return "b" if not end else "" if end[-1] in ".!?" else "t"


def _illegal(initials: list[str]) -> int:
    return sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))


def _letter(initial: str, cut: bool) -> str:
    letter = initial if initial in ("s", "u", "a") else "o"
    return letter.upper() if cut else letter


def repair_one(rows: list[tuple]) -> dict:
    """Repairs one conversation of (turn, role, text) in order."""
    seen, letters, count = set(), [], {"b": 0, "d": 0, "t": 0}
    for _, role, text in rows:
        fault = _fault(text)
        if fault != "b" and (role, text) in seen:
            fault = "d"
        seen.add((role, text))
        if fault:
            count[fault] += 1
        letters.append("x" if fault in ("b", "d") else _letter(role[:1], fault == "t"))
    cost, audit = weave("".join(letters))
    turns, left = [], iter(rows)
    for edit, target in targets(audit, _odd(audit)):
        _, role, text = next(left) if edit != "I" else (None, "", "")
        if edit != "D":
            turns.append((edit, role if edit == "K" else ROLE[target], text))
    known = [t for t, _, _ in rows if t is not None]
    return {"gaps": max(known) - min(known) + 1 - len(set(known)) if known else 0,
            "blank": count["b"], "duplicate": count["d"], "truncated": count["t"],
            "illegal": _illegal([r[:1] for _, r, _ in rows]), "cost": cost, "audit": audit,
            "turns": turns}


def _order() -> list:
    return [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]


_TURNS = pa.list_(pa.struct([("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]))
_SCHEMA = pa.schema([("conv_id", pa.int64()),
                     *((c.split()[0], pa.int64()) for c in STATS.split(", ")),
                     ("audit", pa.string()), ("turns", _TURNS)])


def _stream(batches):
    """Sorted rows to one row a conversation, one conversation at a time."""
    out, size, current, rows = [], 0, None, None

    def close():
        nonlocal size
        one = repair_one(rows)
        size += 100 + sum(len(t) for _, _, t in rows)
        one["turns"] = [dict(zip(("edit", "role", "text"), t)) for t in one["turns"]]
        out.append({"conv_id": current, **one})

    for b in batches:
        for conv, turn, role, text, copies in zip(*(c.to_pylist() for c in b.columns)):
            if rows is None or conv != current:
                if rows is not None:
                    close()
                current, rows = conv, []
            rows += [(turn, role, text)] * copies
            if size > 8 << 20:
                yield pa.RecordBatch.from_pylist(out, schema=_SCHEMA)
                out, size = [], 0
    if rows is not None:
        close()
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=_SCHEMA)


def _short(rows: DataFrame) -> DataFrame:
    dealt = (rows.select("conv_id", "turn", "role", "text", "copies").repartition("conv_id")
             .sortWithinPartitions(*_order()))
    return dealt.mapInArrow(_stream, SHORT_OUT)


def _align_long(batches):
    """Blocks of letters of one conversation to its cost, audit and the edits of each block: one
    string a turn (k keep, d delete, u/a rerole, U/A inserted before it or at the end)."""
    for b in batches:
        for conv, blocks in zip(b.column("conv_id").to_pylist(), b.column("blocks").to_pylist()):
            blocks.sort(key=lambda x: x["block"])
            cost, audit = weave("".join(x["letters"] for x in blocks), folded)
            edits, at = [""] * (len(audit) - audit.count("I")), 0
            for edit, target in targets(audit, _odd(audit)):
                if edit == "I":
                    edits[min(at, len(edits) - 1)] += target.upper()
                else:
                    edits[at] += "k" if edit == "K" else "d" if edit == "D" else target
                    at += 1
            at, out = 0, []
            for x in blocks:
                n = len(x["letters"])
                out.append({"conv_id": conv, "block": x["block"], "first": x["first"],
                            "edits": edits[at:at + n], "cost": None, "audit": None})
                at += n
            out.append({"conv_id": conv, "block": -1, "first": None, "edits": None,
                        "cost": cost, "audit": audit})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([
                ("conv_id", pa.int64()), ("block", pa.int64()), ("first", pa.int64()),
                ("edits", pa.list_(pa.string())), ("cost", pa.int64()), ("audit", pa.string())]))


def _digest(batches):
    """Sorted (conv_id, line) to the digest of each conversation's lines."""
    current, digest = None, None
    names = ["conv_id", "repaired_sha256"]

    def close():
        return pa.RecordBatch.from_arrays([pa.array([current], pa.int64()),
                                           pa.array([digest.hexdigest()])], names=names)

    for b in batches:
        for conv, line in zip(b.column("conv_id").to_pylist(), b.column("line")):
            line = line.as_py()
            if digest is None or conv != current:
                if digest is not None:
                    yield close()
                current, digest, empty = conv, hashlib.sha256(), True
            if line is not None:
                digest.update(line.encode() if empty else b"\n" + line.encode())
                empty = False
    if digest is not None:
        yield close()


def _long(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(one row a conversation with its statistics and audit, its repaired turns as
    conv_id, place, sub, role, text) of conversations of any size."""
    spark = rows.sparkSession
    turns = write_stage(rows.filter("copies > 0").withColumn(
        "_c", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(
        "conv_id", "turn", "role", "text", F.rand(7).alias("_t")), "long-turns")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    placed = write_stage(turns.repartitionByRange(parts, *_order(), F.col("_t"))
                         .sortWithinPartitions(*_order(), F.col("_t"))
                         .select("conv_id", "turn", "role", "text",
                                 F.monotonically_increasing_id().alias("place")), "long-placed")
    key = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    end = F.rtrim(F.col("text"), F.lit(WHITE))
    keyed = placed.select("conv_id", "turn", "place", key.alias("_key"),
                          F.expr(f"place div {BLOCK}").alias("block"),
                          F.substring("role", 1, 1).alias("initial"), (end == "").alias("blank"),
                          F.substring(end, -1, 1).isin(".", "!", "?").alias("ended"))
    first = (keyed.groupBy("conv_id", "_key").agg(F.min("place").alias("_first"))
             .withColumnRenamed("conv_id", "_conv").withColumnRenamed("_key", "_of"))
    faulty = keyed.join(first, F.col("conv_id").eqNullSafe(F.col("_conv"))
                        & (F.col("_key") == F.col("_of")))
    repeat = ~F.col("blank") & (F.col("place") > F.col("_first"))
    cut = ~F.col("blank") & ~repeat & ~F.col("ended")
    known = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("o")
    letter = (F.when(F.col("blank") | repeat, "x").when(cut, F.upper(known)).otherwise(known))
    blocks = write_stage(
        faulty.groupBy("conv_id", "block").agg(
            F.min("place").alias("first"), F.sum(F.col("blank").cast("long")).alias("blank"),
            F.sum(repeat.cast("long")).alias("duplicate"), F.sum(cut.cast("long")).alias("truncated"),
            F.min("turn").alias("low"), F.max("turn").alias("high"),
            F.array_sort(F.collect_list(F.struct("place", letter.alias("l"), "initial")))
            .alias("_all"))
        .select("*", F.array_join(F.transform("_all", lambda x: x["l"]), "").alias("letters"),
                F.transform("_all", lambda x: x["initial"]).alias("initials")).drop("_all"),
        "long-blocks")
    before = F.lag(F.element_at("initials", -1)).over(
        Window.partitionBy("conv_id").orderBy("block"))
    pair = F.concat(F.col("_in")[F.col("_i")], F.col("_in")[F.col("_i") + 1])
    pairs = (blocks.select("conv_id", F.when(before.isNull(), F.col("initials")).otherwise(
        F.concat(F.array(before), F.col("initials"))).alias("_in"))
        .filter(F.size("_in") > 1)
        .select("conv_id", "_in", F.explode(F.sequence(F.lit(0), F.size("_in") - 2)).alias("_i"))
        .groupBy("conv_id").agg(F.sum((~pair.isin(*sorted(LEGAL))).cast("long")).alias("illegal")))
    distinct = (placed.filter("turn IS NOT NULL").select("conv_id", "turn").distinct()
                .groupBy("conv_id").agg(F.count("*").alias("n")))
    stats = blocks.groupBy("conv_id").agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")],
        F.min("low").alias("low"), F.max("high").alias("high"))
    edits = write_stage(
        blocks.groupBy("conv_id").agg(F.collect_list(F.struct("block", "first", "letters"))
                                      .alias("blocks"))
        .mapInArrow(_align_long, "conv_id long, block long, first long, edits array<string>, "
                                 "cost long, audit string"), "long-edits")

    def same(a: DataFrame, b: DataFrame, how: str = "left") -> DataFrame:
        other = b.withColumnRenamed("conv_id", "_other")
        return a.join(other, F.col("conv_id").eqNullSafe(F.col("_other")), how).drop("_other")

    result = same(same(same(edits.filter("block < 0").select("conv_id", "cost", "audit"), stats),
                       pairs), distinct)
    zero = F.lit(0).cast("long")
    result = result.select(
        "conv_id", F.coalesce(F.col("high") - F.col("low") + 1 - F.col("n"), zero).alias("gaps"),
        "blank", "duplicate", "truncated", F.coalesce("illegal", zero).alias("illegal"),
        "cost", "audit")
    by = edits.filter("block >= 0").select(
        F.col("conv_id").alias("_other"), F.col("block").alias("_block"), "first", "edits")
    edited = placed.withColumn("block", F.expr(f"place div {BLOCK}")).join(
        by, F.col("conv_id").eqNullSafe(F.col("_other")) & (F.col("block") == F.col("_block")))
    edit = F.expr("edits[cast(place - first as int)]")
    steps = edited.select("conv_id", "place", "role", "text",
                          F.posexplode(F.split(edit, "(?!^)")).alias("sub", "edit"))
    steps = steps.filter("edit NOT IN ('', 'd')")
    role = (F.when(F.col("edit") == "k", F.col("role")).when(
        F.lower("edit") == "u", "user").otherwise("assistant"))
    text = F.when(F.col("edit").isin("U", "A"), "").otherwise(F.col("text"))
    repaired = steps.select("conv_id", "place", "sub", role.alias("role"),
                                                  text.alias("text"))
    return result, repaired


def _split(rows: DataFrame, max_rows: int, max_bytes: int) -> tuple[DataFrame, DataFrame | None]:
    """(rows of conversations within the bounds, rows of longer ones or None)."""
    big = write_stage(
        rows.groupBy("conv_id").agg(F.sum("copies").alias("_n"),
                                    F.sum(F.octet_length("text") * F.col("copies")).alias("_b"))
        .filter((F.col("_n") > max_rows) | (F.col("_b") > max_bytes))
        .select(F.col("conv_id").alias("_big")), "long-conversations")
    if big.isEmpty():
        return rows, None
    on = F.col("conv_id").eqNullSafe(F.col("_big"))
    return rows.join(big, on, "left_anti"), rows.join(big, on, "left_semi")


def repair(rows: DataFrame, max_rows: int = ROWS, max_bytes: int = BYTES) -> DataFrame:
    """Statistics, cost, audit and digest of the repaired turns of every conversation. ``rows``:
    conv_id, turn, role, text and copies, as ``damage`` gives them; a conversation with no
    copies at all has zeros, an empty audit and the digest of nothing."""
    near, far = _split(rows, max_rows, max_bytes)
    names = [c.split()[0] for c in SHORT_OUT.split(", ")[:8]]
    line = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])),
                        "\n")
    short = _short(near).select(*names, F.sha2(line.cast("binary"), 256).alias("repaired_sha256"))
    if far is None:
        return short
    result, repaired = _long(far)
    every = result.select("conv_id", F.lit(-1).cast("long").alias("place"), F.lit(0).alias("sub"),
                          F.lit(None).cast("string").alias("line"))
    lines = repaired.select("conv_id", "place", "sub", F.concat("role", F.lit(":"), "text")
                            .alias("line"))
    digests = (every.unionByName(lines).repartition("conv_id")
               .sortWithinPartitions("conv_id", "place", "sub").select("conv_id", "line")
               .mapInArrow(_digest, "conv_id long, repaired_sha256 string")
               .withColumnRenamed("conv_id", "_other"))
    return short.unionByName(result.join(digests, F.col("conv_id").eqNullSafe(F.col("_other")))
                             .select(*names, "repaired_sha256"))


def repaired_turns(rows: DataFrame, max_rows: int = ROWS, max_bytes: int = BYTES) -> DataFrame:
    """The repaired conversations themselves: conv_id, place (in order, gaps possible), sub,
    role, text."""
    near, far = _split(rows, max_rows, max_bytes)
    short = _short(near).select("conv_id", F.posexplode("turns").alias("place", "_t")).select(
        "conv_id", F.col("place").cast("long").alias("place"), F.lit(0).alias("sub"),
        F.col("_t.role").alias("role"), F.col("_t.text").alias("text"))
    return short if far is None else short.unionByName(_long(far)[1])


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damages, then repairs every conversation of the table."""
    return repair(damage(spark.read.parquet(f"{sf_dir}/conversations.parquet")))
