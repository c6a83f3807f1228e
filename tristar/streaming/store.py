"""A keyed table on the shared folder, written once per micro-batch.

``KeyedStore`` keeps the current row of each key as one *base* folder and the *deltas* of the
batches since, each holding only the keys that batch changed. A small manifest per version
names the folders that make it up, so

* version n is read by merging its base and deltas (the latest row per key wins, an aggregate
  that combines map-side), whatever later batches write: a replayed batch n reads version
  n - 1 again and replaces its own version n;
* after ``compact_every`` deltas the merged table is written as a new base;
* folders that neither the last nor the last but one manifest names are retired, so the size on
  disk follows the number of keys, not the number of batches.

Manifests are listed and read through the file system of the folder; no data file is listed on
the driver. Keys compare null-safe (a null key is a key).
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VERSION, GONE = "__version", "__gone"


class KeyedStore:
    """``key`` columns and value columns of ``schema``, versioned by batch id."""

    def __init__(self, root: str, key: Sequence[str] | str, schema: T.StructType | str,
                 compact_every: int = 8):
        self.root = root.rstrip("/")
        self.key = [key] if isinstance(key, str) else list(key)
        self.schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        missing = set(self.key) - set(self.schema.names)
        if missing:
            raise ValueError(f"key columns {sorted(missing)} are not in the schema")
        self.values = [c for c in self.schema.names if c not in self.key]
        self.compact_every = max(1, int(compact_every))

    # ---- files ----

    def _fs(self, spark: SparkSession, path: str):
        jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
        return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path

    def _names(self, spark: SparkSession, folder: str) -> list[str]:
        fs, path = self._fs(spark, f"{self.root}/{folder}")
        return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []

    def _versions(self, spark: SparkSession) -> list[int]:
        return sorted(int(n) for n in self._names(spark, "manifest") if n.isdigit())

    def _manifest(self, spark: SparkSession, version: int | None) -> dict | None:
        """The manifest of the highest version up to ``version`` (None: of all)."""
        known = [v for v in self._versions(spark) if version is None or v <= version]
        if not known:
            return None
        fs, path = self._fs(spark, f"{self.root}/manifest/{known[-1]}")
        stream = fs.open(path)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _commit(self, spark: SparkSession, manifest: dict) -> None:
        fs, path = self._fs(spark, f"{self.root}/manifest/{manifest['version']}")
        _, draft = self._fs(spark, f"{self.root}/manifest/.{manifest['version']}")
        stream = fs.create(draft, True)
        try:
            stream.write(bytearray(json.dumps(manifest).encode()))
        finally:
            stream.close()
        fs.delete(path, False)
        if not fs.rename(draft, path):
            raise OSError(f"could not commit {path.toString()}")

    def _retire(self, spark: SparkSession) -> None:
        kept = self._versions(spark)[-2:]
        named = set()
        for v in kept:
            m = self._manifest(spark, v)
            named |= {f"base/{m['base']}"} | {f"delta/{d}" for d in m["deltas"]} | {f"delta/{v}"}
        for folder in ("base", "delta"):
            for name in self._names(spark, folder):
                if name.isdigit() and f"{folder}/{name}" not in named:
                    fs, path = self._fs(spark, f"{self.root}/{folder}/{name}")
                    fs.delete(path, True)
        for v in self._versions(spark):
            if kept and v < kept[0]:
                fs, path = self._fs(spark, f"{self.root}/manifest/{v}")
                fs.delete(path, False)

    # ---- rows ----

    def _stored(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField(GONE, T.BooleanType()),
                             T.StructField(VERSION, T.LongType())])

    def _merged(self, spark: SparkSession, manifest: dict | None) -> DataFrame:
        if manifest is None:
            return spark.createDataFrame([], self.schema)
        base = [] if manifest["base"] is None else [f"{self.root}/base/{manifest['base']}"]
        paths = base + [f"{self.root}/delta/{d}" for d in manifest["deltas"]]
        rows = spark.read.schema(self._stored()).parquet(*paths)
        if not manifest["deltas"]:
            return rows.select(*self.schema.names)
        last = (rows.groupBy(*self.key)
                .agg(F.max_by(F.struct(*self.values, GONE), F.col(VERSION)).alias("__last"))
                .filter(~F.col(f"__last.{GONE}")))
        return last.select(*[c if c in self.key else F.col(f"__last.{c}").alias(c)
                             for c in self.schema.names])

    def latest_version(self, spark: SparkSession) -> int | None:
        return next(iter(self._versions(spark)[-1:]), None)

    def read(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """The table as of ``version`` (the last two are kept), by default the newest."""
        return self._merged(spark, self._manifest(spark, version))

    def delta(self, spark: SparkSession, version: int) -> DataFrame:
        """The rows that batch ``version`` wrote (with ``__gone``)."""
        return spark.read.schema(self._stored()).parquet(
            f"{self.root}/delta/{version}").drop(VERSION)

    def upsert(self, rows: DataFrame, version: int) -> None:
        """Replaces or adds the row of each key of ``rows`` (one row a key; a true ``__gone``
        deletes it) and commits version ``version``, replacing an earlier attempt at it."""
        spark = rows.sparkSession
        gone = F.coalesce(F.col(GONE), F.lit(False)) if GONE in rows.columns else F.lit(False)
        (rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields],
                     gone.alias(GONE), F.lit(int(version)).cast("long").alias(VERSION))
         .write.mode("overwrite").parquet(f"{self.root}/delta/{version}"))
        before = self._manifest(spark, version - 1) or {"base": None, "deltas": []}
        manifest = {"version": version, "base": before["base"],
                    "deltas": [*before["deltas"], version]}
        if len(manifest["deltas"]) > self.compact_every:
            (self._merged(spark, manifest)
             .select("*", F.lit(False).alias(GONE), F.lit(int(version)).cast("long").alias(VERSION))
             .write.mode("overwrite").parquet(f"{self.root}/base/{version}"))
            manifest.update(base=version, deltas=[])
        self._commit(spark, manifest)
        self._retire(spark)
