"""Snapshots kept with a tree of digests, so that the next difference reads only what changed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.functions.names import columns, quote
from tidemark.functions.rows import comparable
from tidemark.operators.snapshot import snapshot_diff
from tidemark.sinks.storage import exists
from tidemark.sinks.tables import VersionedTable

LEAF = "_leaf"
BRANCHES = 8
DIGEST = "level int, node int, n long, a decimal(38,0), b decimal(38,0)"


class SnapshotArchive(VersionedTable):
    """Versions whose rows are dealt to ``leaves`` folders by their hash, each with a digest beside it.

    A digest is the number of a leaf's rows and two sums of independent 64-bit row hashes, so it depends neither on the order of rows
    nor on how they lie in files, and copies count. Digests of leaves add up to those of branches. Two versions are compared
    from the branches down; only leaves that differ are read, and compared exactly. That equal digests hide a difference has a
    chance of some 2**-128 per leaf. ``leaves`` should leave some hundred MB to a leaf; versions with unlike numbers are compared whole.
    """

    def __init__(self, spark, path: str, leaves: int = 64, **options):
        super().__init__(spark, path, **options)
        self.leaves = leaves

    def write(self, df: DataFrame) -> int:
        version = (self.versions() or [0])[-1] + 1
        path = self.version_path(version)
        leaf = F.pmod(_hash(df, 0), F.lit(self.leaves)).cast("int")
        # rebalancing splits a leaf that holds a huge group of copies
        df.withColumn(LEAF, leaf).hint("rebalance", F.col(LEAF)).write.mode("overwrite").option("compression", "snappy").partitionBy(LEAF).parquet(path)
        df.limit(0).write.mode("overwrite").parquet(f"{path}/_schema")  # names with an underscore are no data
        rows = self._rows(version)
        sums = [F.sum(_hash(df, seed).cast("decimal(38,0)")).cast("decimal(38,0)").alias(name) for seed, name in ((1, "a"), (2, "b"))]
        low = rows.groupBy(LEAF).agg(F.count(F.lit(1)).alias("n"), *sums)
        high = low.groupBy((F.col(LEAF) % BRANCHES).alias(LEAF)).agg(F.sum("n").alias("n"), *[F.sum(c).cast("decimal(38,0)").alias(c) for c in "ab"])
        both = [d.select(F.lit(level).alias("level"), F.col(LEAF).alias("node"), "n", "a", "b") for level, d in ((1, high), (2, low))]
        size = self.spark.range(1).select(F.lit(0).alias("level"), F.lit(self.leaves).alias("node"), F.lit(0).cast("long").alias("n"),
                                          *[F.lit(0).cast("decimal(38,0)").alias(c) for c in "ab"])
        reduce(DataFrame.unionAll, both, size).coalesce(1).write.mode("overwrite").parquet(f"{path}/_digests")
        return version

    def read(self, version: int | None = None) -> DataFrame | None:
        version = version or self.current()
        return None if version is None else self._rows(version).drop(LEAF)

    def _rows(self, version: int) -> DataFrame:
        path = self.version_path(version)
        if not exists(self.spark, f"{path}/_schema"):
            return self.spark.read.parquet(path)  # written before there were digests
        schema = self.spark.read.parquet(f"{path}/_schema").schema
        return self.spark.read.schema(schema.add(LEAF, T.IntegerType())).parquet(path)

    def changed_leaves(self, new: int, old: int) -> list[int] | None:
        """Leaves in which the two versions differ; None where their digests cannot be compared."""
        paths = [f"{self.version_path(v)}/_digests" for v in (new, old)]
        if not all(exists(self.spark, p) for p in paths):
            return None
        sides = [self.spark.read.schema(DIGEST).parquet(p) for p in paths]

        def unlike(level, nodes=None) -> list[int]:
            rows = [d.where(F.col("level") == level) for d in sides]
            if nodes is not None:
                rows = [d.where((F.col("node") % BRANCHES).isin(nodes)) for d in rows]
            once = rows[0].unionAll(rows[1]).groupBy(*rows[0].columns).agg(F.count(F.lit(1)).alias("sides")).where("sides = 1")
            return sorted(r["node"] for r in once.select("node").distinct().collect())  # at most one row per leaf

        if unlike(0):
            return None
        branches = unlike(1)
        return unlike(2, branches) if branches else []

    def diff(self, new: int, old: int) -> DataFrame:
        """As :func:`snapshot_diff` of the two versions."""
        leaves = self.changed_leaves(new, old)
        sides = [self._rows(v) for v in (new, old)]
        if leaves is not None:
            sides = [d.where(F.col(LEAF).isin(leaves) if leaves else F.lit(False)) for d in sides]
        names = [c for c in sides[0].columns if c != LEAF]
        return snapshot_diff(*[d.select(*columns(names)) for d in sides])


def _hash(df: DataFrame, seed: int):
    """Of all columns, by name, in a form that can be hashed."""
    forms = [F.expr(comparable(quote(f.name), f.dataType)) for f in sorted(df.schema.fields, key=lambda f: f.name) if f.name != LEAF]
    nulls = [F.col(quote(f.name)).isNull() for f in df.schema.fields if f.name != LEAF]
    return F.xxhash64(F.lit(seed), *forms, *nulls)
