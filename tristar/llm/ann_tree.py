"""Approximate nearest neighbours: a hierarchical k-means tree, searched best bin first.

A tree of centroids is fitted on the driver from at most ``SAMPLE`` unit vectors (lowest
id hashes): each node's vectors are split by k-means into ``BRANCH`` children until
``LEAF`` or fewer are left. All vectors are then indexed by descending the tree. A query
walks the tree with a priority queue of nodes ordered by distance to their centroid and
visits leaves in that order; how many leaves is calibrated once, widening until
sample queries reach the target recall against brute force over the sample. The tree
(at most a few sample sizes / leaf sizes of centroids) is the only thing broadcast.

Candidates and queries meet by leaf. Large leaves are cut into blocks of candidates and of
queries by id hash, so no task holds a whole hot leaf. Of equal vectors only the ids that can
appear in a result are kept per input batch (the smallest k + 1), which shrinks a vector
with very many copies before anything is shuffled and loses nothing. Scores are cosines
of the original vectors in double precision.

Defined results: vectors that are null, empty, zero, hold null or non-finite components, or
differ in dimension from the most frequent one take no part; null ids take no part. A
row repeated exactly counts once. A query with fewer than k candidates gets all found.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tristar.session import write_stage

SAMPLE = 20_000
BRANCH, LEAF = 8, 400
K = 5
TARGET = 0.95            # calibrated recall on the sample
VECTORS, QUERIES = 512, 2048   # candidates and queries per block at most, on average
CALIBRATION = 300


def _unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


class Tree:
    """Centroids, children and leaf numbers of each node; node 0 is the root."""

    def __init__(self, x: np.ndarray, branch: int = BRANCH, leaf: int = LEAF, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.center, self.child, self.leaf_of = [x.mean(axis=0)], [[]], [-1]
        self.leaves = 0
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            parts = self._split(x, rows, branch, rng) if len(rows) > leaf else []
            if len(parts) < 2:
                self.leaf_of[node] = self.leaves
                self.leaves += 1
                continue
            for part in parts:
                self.center.append(x[part].mean(axis=0))
                self.child.append([])
                self.leaf_of.append(-1)
                self.child[node].append(len(self.center) - 1)
                todo.append((len(self.center) - 1, part))
        self.center = np.array(self.center)

    @staticmethod
    def _split(x, rows, branch, rng, steps: int = 12):
        own = x[rows]
        distinct = np.unique(own[:4096], axis=0)
        if len(distinct) < 2:
            return []
        center = distinct[rng.permutation(len(distinct))[:branch]]
        for _ in range(steps):
            near = (own @ center.T - 0.5 * (center * center).sum(axis=1)).argmax(axis=1)
            center = np.array([own[near == j].mean(axis=0) for j in np.unique(near)])
        near = (own @ center.T - 0.5 * (center * center).sum(axis=1)).argmax(axis=1)
        return [rows[near == j] for j in np.unique(near)]

    def _distance(self, x: np.ndarray) -> np.ndarray:
        return -2 * (x @ self.center.T) + (self.center * self.center).sum(axis=1)

    def descend(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each vector: the nearest child all the way down."""
        out = np.zeros(len(x), np.int32)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if not len(rows):
                continue
            if self.leaf_of[node] >= 0:
                out[rows] = self.leaf_of[node]
                continue
            child = np.array(self.child[node])
            c = self.center[child]
            near = (x[rows] @ c.T - 0.5 * (c * c).sum(axis=1)).argmax(axis=1)
            todo += [(int(child[j]), rows[near == j]) for j in range(len(child))]
        return out

    def best_bins(self, x: np.ndarray, visits: int) -> list[list[int]]:
        """The first leaves each query reaches, nearest nodes first."""
        out = []
        for far in self._distance(x):
            queue, found = [(0.0, 0)], []
            while queue and len(found) < visits:
                _, node = heapq.heappop(queue)
                if self.leaf_of[node] >= 0:
                    found.append(self.leaf_of[node])
                for c in self.child[node]:
                    heapq.heappush(queue, (far[c], c))
            out.append(found)
        return out

    def calibrate(self, x: np.ndarray, k: int = K, target: float = TARGET) -> int:
        """Fewest leaf visits (widening by a quarter) whose recall on sample queries reaches
        the target."""
        query = x[:CALIBRATION]
        leaf = self.descend(x)
        score = query @ x.T
        score[np.arange(len(query)), np.arange(len(query))] = -np.inf
        kth = -np.sort(-score, axis=1)[:, min(k, len(x) - 1) - 1] if len(x) > 1 else None
        if kth is None:
            return self.leaves
        visits = 1
        while visits < self.leaves:
            bins = self.best_bins(query, visits)
            got = [np.minimum((score[i][np.isin(leaf, b)] >= kth[i] - 1e-12).sum(), k)
                   for i, b in enumerate(bins)]
            if np.mean(got) >= target * min(k, len(x) - 1):
                break
            visits = max(visits + 1, visits * 5 // 4)
        return min(visits, self.leaves)


def clean_vectors(rows: DataFrame, k: int = K, every: int = 50) -> DataFrame:
    """(vec_id, v, query): usable vectors as bytes of doubles. Per batch, equal vectors keep
    their k + 1 smallest ids as candidates; queries are always kept (as such)."""
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"),
                       F.col("embedding").cast("array<double>").alias("embedding"))
    common = (rows.groupBy(F.size("embedding").alias("d")).count().filter("d > 0")
              .orderBy(F.desc("count"), F.desc("d")).first())
    d = common["d"] if common else 1

    def run(batches):
        for b in batches:
            usable = pc.and_(pc.is_valid(b.column("vec_id")), pc.fill_null(
                pc.equal(pc.list_value_length(b.column("embedding")), d), False))
            b = b.filter(usable)
            if not b.num_rows:
                continue
            ids = b.column("vec_id").to_numpy()
            flat = pc.list_flatten(b.column("embedding")).to_numpy(zero_copy_only=False)
            v = flat.astype(np.float64).reshape(-1, d)  # null components become NaN
            ok = np.isfinite(v).all(axis=1) & (v != 0).any(axis=1)
            ids, v = ids[ok], np.ascontiguousarray(v[ok]) + 0.0
            if not len(ids):
                continue
            order = np.argsort(ids, kind="stable")
            ids, v = ids[order], v[order]
            raw = [x.tobytes() for x in v]
            seen: dict[bytes, int] = {}
            keep = np.zeros(len(ids), bool)
            for i, x in enumerate(raw):
                n = seen.get(x, 0)
                keep[i] = n <= k
                seen[x] = n + 1
            query = ids % every == 0
            take = np.flatnonzero(keep | query)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[take]), pa.array([raw[i] for i in take], pa.binary()),
                 pa.array(query[take]), pa.array(keep[take])],
                names=["vec_id", "v", "query", "candidate"])

    return rows.mapInArrow(run, "vec_id long, v binary, query boolean, candidate boolean")


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(len(column), -1)


def best_of_block(qid, q, cid, c, k: int):
    """(query, candidate, score) of the k best of a block of candidates, ties to the smaller
    id. Scores are one row-wise sum each, so equal vectors score equally."""
    order = np.argsort(cid, kind="stable")
    cid, c = cid[order], c[order]
    qs, cs = np.abs(q).max(axis=1, keepdims=True), np.abs(c).max(axis=1, keepdims=True)
    qn, cn = np.sqrt(((q / qs) ** 2).sum(axis=1)), np.sqrt(((c / cs) ** 2).sum(axis=1))
    q, c = q / qs, c / cs
    rough = (q / qn[:, None]) @ (c / cn[:, None]).T
    rough[qid[:, None] == cid[None, :]] = -np.inf
    wide = min(3 * k + 8, len(cid))
    top = np.argpartition(-rough, wide - 1, axis=1)[:, :wide] if wide < len(cid) else \
        np.tile(np.arange(len(cid)), (len(qid), 1))
    out = []
    for i, cols in enumerate(top):
        cols = np.sort(cols[np.isfinite(rough[i, cols])])
        score = (q[i] * c[cols]).sum(axis=1) / (qn[i] * cn[cols])
        # Equal scores may reach past the partition: then look at every candidate as good.
        if len(cols) >= wide and wide < len(cid) and \
                np.sort(score)[-min(k, len(score))] <= rough[i, cols].min() + 1e-9:
            cols = np.flatnonzero(rough[i] >= rough[i, cols].min() - 1e-9)
            score = (q[i] * c[cols]).sum(axis=1) / (qn[i] * cn[cols])
        best = np.lexsort((cid[cols], -score))[:k]
        out += [(int(qid[i]), int(cid[cols[b]]), float(score[b])) for b in best]
    return out


def search(rows: DataFrame, k: int = K, every: int = 50, sample: int = SAMPLE,
           target: float = TARGET) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest found of each query row (vec_id
    divisible by ``every``)."""
    spark = rows.sparkSession
    result = "query_id long, rank int, vec_id long, score double"
    vectors = clean_vectors(rows, k, every).distinct()
    picked = (vectors.select("vec_id", "v").orderBy(F.xxhash64("vec_id"), "vec_id", "v")
              .limit(sample).collect())
    if not picked:
        return spark.createDataFrame([], result)
    x = _unit(np.frombuffer(b"".join(r["v"] for r in picked), np.float64).reshape(len(picked), -1))
    tree = Tree(x)
    visits = tree.calibrate(x, k, target)

    def index(batches):
        for b in batches:
            if b.num_rows:
                v = _matrix(b.column("v"))
                yield pa.RecordBatch.from_arrays(
                    [*b.columns, pa.array(tree.descend(_unit(v)))], names=[*b.schema.names, "leaf"])

    def walk(batches):
        for b in batches:
            if b.num_rows:
                bins = tree.best_bins(_unit(_matrix(b.column("v"))), visits)
                at = np.repeat(np.arange(b.num_rows), [len(x) for x in bins])
                yield pa.RecordBatch.from_arrays(
                    [b.column("vec_id").take(pa.array(at)), b.column("v").take(pa.array(at)),
                     pa.array(np.concatenate(bins).astype(np.int32))], names=["query_id", "q", "leaf"])

    indexed = write_stage(vectors.mapInArrow(
        index, "vec_id long, v binary, query boolean, candidate boolean, leaf int"), "ann-index")
    visited = (indexed.filter("query").select("vec_id", "v")
               .mapInArrow(walk, "query_id long, q binary, leaf int"))
    # Per leaf (at most a few times sample / LEAF rows): blocks of candidates and of queries.
    n_c = {r["leaf"]: r["n"] for r in indexed.filter("candidate").groupBy("leaf")
           .agg(F.count("*").alias("n")).collect()}
    n_q = {r["leaf"]: r["n"] for r in visited.groupBy("leaf").agg(F.count("*").alias("n")).collect()}
    blocks = spark.createDataFrame(
        [(leaf, -(-n // VECTORS), -(-n_q.get(leaf, 1) // QUERIES)) for leaf, n in n_c.items()],
        "leaf int, c_blocks int, q_blocks int")
    one = lambda col, n: F.pmod(F.xxhash64(col), F.col(n)).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = (visited.join(F.broadcast(blocks), "leaf")
            .select("leaf", one("query_id", "q_blocks").alias("qb"), all_of("c_blocks").alias("cb"),
                    "query_id", "q"))
    right = (indexed.filter("candidate").join(F.broadcast(blocks), "leaf")
             .select("leaf", all_of("q_blocks").alias("qb"), one("vec_id", "c_blocks").alias("cb"),
                     "vec_id", "v"))

    def meet(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        out = []
        if queries.num_rows and candidates.num_rows:
            out = best_of_block(queries.column("query_id").to_numpy(), _matrix(queries.column("q")),
                                candidates.column("vec_id").to_numpy(),
                                _matrix(candidates.column("v")), k)
        return pa.table([pa.array([r[i] for r in out], t) for i, t in
                         enumerate((pa.int64(), pa.int64(), pa.float64()))],
                        names=["query_id", "vec_id", "score"])

    keys = ["leaf", "qb", "cb"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        meet, "query_id long, vec_id long, score double").distinct()
    nearest = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(nearest)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
