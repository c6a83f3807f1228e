"""Toxicity: a weighted finite-state pattern grammar over clauses.

Texts are cut into clauses at sentence punctuation and line ends. Within a clause, four
small transducers read one token class at a time and are composed into one machine (its
state is the tuple of theirs):

* *insult* and *threat*: emit a match with the matched word's weight;
* *target*: words that address someone open a window of a few tokens, on both sides;
* *negation*: a negating word, or any contraction with n't, covers the next few tokens;
* *reported speech*: a reporting word covers the rest of its clause.

A match leaves the machine as plain, targeted or discounted (negated or reported). A text
is described by the weight that left through each of the three, saturating with log1p;
a logistic regression over them, calibrated by Platt scaling, gives the score.

The insult lexicon is learned: for every word, the number of distinct preceding words it has
in toxic and in other labelled training texts. Counting contexts instead of occurrences
makes copies of a text count once. A word enters with log odds of at least ``MIN_LOG_ODDS``
that are ``MIN_Z`` standard errors above zero. At most ``sample`` labelled texts per class
are read (lowest id hashes first), and the lexicon keeps at most ``LEXICON`` words.

Defined results: null and empty texts have no clause and get the base score; without
toxic or without other labelled rows every score is 0. Repeated rows are scored each;
only doc_id and text (and doc_id and toxic of the labels) are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tristar.llm import textgrid as tg
from tristar.llm.linear import Sparse, fit, platt, sigmoid
from tristar.llm.quality_rules import labelled_sample
from tristar.session import write_stage

SAMPLE = 5000
LEXICON = 4096
MIN_CONTEXTS, MIN_LOG_ODDS, MIN_Z = 4, 3.5, 3.3
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORTED = range(6)
NEGATION_SPAN, TARGET_SPAN = 3, 4
THREAT_WEIGHT = 1.0
PLAIN, TARGETED, DISCOUNTED = range(3)

# Closed word classes of the grammar in English, German, French and Spanish.
WORDS = {
    THREAT: "kill hurt destroy punish shoot stab burn töten umbringen zerstören verletzen "
            "tuer détruire frapper blesser matar destruir golpear herir",
    TARGET: "you your yours yourself u ur he she they them him her du dich dir dein ihr euch "
            "tu te toi ton vous votre vos usted ustedes ti vosotros tú",
    NEGATION: "not no never neither nor without isn't don't aren't kein keine nie niemals "
              "jamais sans ne nunca jamás sin tampoco",
    REPORTED: "said says say wrote writes claimed quoted reported called according sagte "
              "sagt schrieb berichtete dit disait écrit selon dijo dice escribió según",
}
_BREAK = np.zeros(256, bool)
_BREAK[list(b".!?;:\n\r")] = True


def _hash_words(words: list[str]) -> np.ndarray:
    raw = [w.encode() for w in words]
    off = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    data = tg.LOWER[np.frombuffer(b"".join(raw), np.uint8)]
    return tg.span_hash(data, off[:-1], off[1:])


def _contracted(data: np.ndarray, t: tg.Words, off: np.ndarray) -> np.ndarray:
    """Which tokens end a negation n't: a t after an apostrophe, where tokens break, or a whole
    word with the typographic one, where they do not."""
    first = off[t.text]

    def at(back: int, byte: int) -> np.ndarray:
        place = t.end - back
        return (place >= first) & (data[np.maximum(place, 0)] == byte)

    last = at(1, 0x74)
    plain = last & (t.end - t.start == 1) & at(2, 0x27) & at(3, 0x6E)
    bent = last & (t.end - t.start > 5) & at(2, 0x99) & at(3, 0x80) & at(4, 0xE2) & at(5, 0x6E)
    return plain | bent


class Grammar:
    """Composed machine: token classes and weights by word hash."""

    def __init__(self, lexicon: dict[int, float]):
        entry = {int(h): (kind, THREAT_WEIGHT if kind == THREAT else 0.0)
                 for kind, text in WORDS.items()
                 for h in _hash_words([w for w in text.split() if "'" not in w])}
        entry.update({h: (INSULT, w) for h, w in lexicon.items()})
        keys = np.array(sorted(entry), np.uint64)
        self.keys = keys
        self.kind = np.array([entry[int(k)][0] for k in keys], np.int8)
        self.weight = np.array([entry[int(k)][1] for k in keys])

    def classes(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        i = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
        hit = self.keys[i] == h
        return np.where(hit, self.kind[i], OTHER), np.where(hit, self.weight[i], 0.0)

    @staticmethod
    def run(kinds: list[int], weights: list[float]) -> list[tuple[int, float]]:
        """(channel, weight) of each match of one clause."""
        ahead, left = [0] * len(kinds), 0   # target transducer, read from the right
        for i in range(len(kinds) - 1, -1, -1):
            ahead[i] = left
            left = TARGET_SPAN if kinds[i] == TARGET else max(left - 1, 0)
        out, negated, targeted, reported = [], 0, 0, False
        for kind, weight, next_target in zip(kinds, weights, ahead):
            if kind in (INSULT, THREAT):
                out.append((DISCOUNTED if negated or reported else
                            TARGETED if targeted or next_target else PLAIN, weight))
            negated = NEGATION_SPAN if kind == NEGATION else max(negated - 1, 0)
            targeted = TARGET_SPAN if kind == TARGET else max(targeted - 1, 0)
            reported = reported or kind == REPORTED
        return out

    def features(self, texts: pa.Array) -> np.ndarray:
        """log1p of the weight each text sends through each channel."""
        rows = []
        for _, _, data, off in tg.blocks(texts):
            data = tg.LOWER[data]
            t = tg.tokens(data, off)
            kinds, weights = self.classes(tg.span_hash(data, t.start, t.end))
            kinds = np.where(_contracted(data, t, off), NEGATION, kinds)
            text = t.text
            breaks = np.concatenate([[0], np.cumsum(_BREAK[data])])
            clause = breaks[t.start]
            total = np.zeros((len(off) - 1, 3))
            hits = np.flatnonzero((kinds == INSULT) | (kinds == THREAT))
            done = -1
            for i in hits:
                if i <= done:
                    continue
                same = (clause == clause[i]) if len(clause) < 64 else None
                if same is None:  # the clause's tokens are neighbours: find its ends
                    a = max(int(np.searchsorted(clause, clause[i])), int(t.off[text[i]]))
                    b = min(int(np.searchsorted(clause, clause[i], "right")),
                            int(t.off[text[i] + 1]))
                else:
                    at = np.flatnonzero(same & (text == text[i]))
                    a, b = int(at[0]), int(at[-1]) + 1
                for channel, w in self.run(kinds[a:b].tolist(), weights[a:b].tolist()):
                    total[text[i], channel] += w
                done = b - 1
            rows.append(np.log1p(total))
        return np.concatenate(rows) if rows else np.zeros((0, 3))


def _contexts(batches):
    """Distinct (word, word before, label) of each batch, as hashes."""
    for b in batches:
        y = b.column("y").to_numpy(zero_copy_only=False)
        for i, j, data, off in tg.blocks(b.column("text")):
            data = tg.LOWER[data]
            t = tg.tokens(data, off)
            h = tg.span_hash(data, t.start, t.end)
            before = np.concatenate([np.zeros(1, np.uint64), h[:-1]])[:len(h)]
            before[t.off[:-1][np.diff(t.off) > 0]] = 0
            rows = np.unique(np.stack([h, before, y[i:j][t.text].astype(np.uint64)], 1), axis=0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[:, k].view(np.int64) if k < 2 else rows[:, 2].astype(np.int32))
                 for k in range(3)], names=["h", "before", "y"])


def learn_lexicon(sample: DataFrame) -> dict[int, float]:
    """Word hash -> weight (log odds) from labelled texts (columns y, text)."""
    pairs = sample.select("y", "text").mapInArrow(_contexts, "h long, before long, y int").distinct()
    counts = write_stage(pairs.groupBy("h").agg(
        F.sum(F.col("y")).alias("bad"), F.sum(1 - F.col("y")).alias("good")), "contexts")
    total = counts.agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).first()
    if not total["bad"] or not total["good"]:
        return {}
    odds = (F.log((F.col("bad") + 0.5) / float(total["bad"]))
            - F.log((F.col("good") + 0.5) / float(total["good"])))
    error = F.sqrt(1 / (F.col("bad") + 0.5) + 1 / (F.col("good") + 0.5))
    best = (counts.filter(F.col("bad") >= MIN_CONTEXTS)
            .select("h", odds.alias("odds"), (odds / error).alias("z"))
            .filter((F.col("odds") >= MIN_LOG_ODDS) & (F.col("z") >= MIN_Z))
            .orderBy(F.desc("z"), "h").limit(LEXICON).collect())
    return {r["h"] & 0xFFFFFFFFFFFFFFFF: r["odds"] for r in best}


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE):
    """Grammar and calibrated weights from the given labels, or None without both classes."""
    texts, size = labelled_sample(docs, labels, "toxic", sample)
    if len(size) < 2:
        return None
    texts = write_stage(texts, "toxic-sample")
    grammar = Grammar(learn_lexicon(texts))

    def rows(batches):
        for b in batches:
            f = grammar.features(b.column("text"))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("y"), *(pa.array(f[:, k]) for k in range(3))],
                names=["doc_id", "y", "f0", "f1", "f2"])

    got = texts.mapInArrow(rows, "doc_id long, y int, f0 double, f1 double, f2 double").collect()
    got = sorted(got)
    y = np.array([r["y"] for r in got])
    if len(set(y)) < 2:
        return None
    weight = np.array([size[k] / (y == k).sum() for k in (0, 1)])[y]
    x = Sparse.of([(np.arange(3), np.array([r["f0"], r["f1"], r["f2"]])) for r in got])
    w, bias = fit(x, y, weight, 3, steps=300, rate=0.1, l2=1e-3)
    w = np.maximum(w, 0)
    return grammar, w, bias, *platt(x.dot(w) + bias, y, weight)


def score(text: Column, model) -> Column:
    """Probability that a text is toxic."""
    @F.arrow_udf("double")
    def toxic(texts: pa.Array) -> pa.Array:
        if model is None:
            return pa.array(np.zeros(len(texts)))
        grammar, w, bias, a, b = model
        return pa.array(sigmoid(a * (grammar.features(texts) @ w + bias) + b))

    return toxic.asNondeterministic()(text)  # evaluated once per row, never copied


def fold(column: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(column).cast("string")) % 5, F.lit(1))


def judge(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Score and prediction of every document; learns from the labels of folds 1 to 4."""
    model = train(docs, labels.filter(fold() != 0), sample)
    return (docs.select("doc_id", (fold() == 0).alias("held_out"),
                        score(F.col("text"), model).alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def keep_clean(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The documents not predicted toxic, with all their columns."""
    return docs.filter(score(docs["text"], train(docs, labels, sample)) < 0.5)


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                 spark.read.parquet(f"{sf_dir}/labels.parquet"))
