"""Numbering documents into chunks of N without sorting everything in one task."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions.names import column, columns
from tidemark.sinks.storage import scratch_path


def assign_chunks(df: DataFrame, id_col: str, size: int, buckets: int | None = None) -> DataFrame:
    """Add ``chunk`` = (rank by ``id_col`` - 1) div size + 1, for a numeric or temporal id.

    Ranges of the id are cut at quantiles that one sketch aggregation finds, so they hold about equally many
    rows. The rank is the rank within the range plus the number of rows in lower ranges. Counts of parts are summed up
    within each range, in as many tasks as there are ranges; only the ranges' totals (two per bucket) are brought together.

    An id at which several cuts fall is hot. Such an id has a range of its own, whose rows are equal in rank
    and may be numbered in any order; they are spread over ``buckets`` parts, written to the shared folder first
    so that counting and numbering see the same parts.
    """
    buckets = buckets or 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at = [i / buckets for i in range(1, buckets)]
    found = df.agg(F.percentile_approx(column(id_col), at or [0.5], max(10_000, 10 * buckets)).alias("q")).first()["q"] or []
    cuts = sorted(set(found))
    ranged = df.withColumn("_range", _range_number(df, id_col, cuts)).withColumn("_part", F.lit(0).cast("long"))
    if len(cuts) < len(found):
        # odd ranges hold a single id
        part = F.pmod(F.monotonically_increasing_id(), F.lit(buckets).cast("long"))
        path = scratch_path(df.sparkSession, "chunks")
        ranged.withColumn("_part", F.when(F.col("_range") % 2 == 1, part).otherwise(0)).write.parquet(path)
        ranged = df.sparkSession.read.parquet(path)
    counts = ranged.groupBy("_range", "_part").agg(F.count(F.lit(1)).alias("_rows"))
    totals = {r["_range"]: r["n"] for r in counts.groupBy("_range").agg(F.sum("_rows").alias("n")).collect()}
    lower = [0, *itertools.accumulate(totals.get(i, 0) for i in range(2 * len(cuts) + 1))]
    before = F.element_at(F.array(*map(F.lit, lower)).cast("array<bigint>"), F.col("_range").cast("int") + 1)
    rank = F.row_number().over(Window.partitionBy("_range", "_part").orderBy(column(id_col)))
    joined = ranged.withColumns({"_rank": rank, "_before": before})
    if len(cuts) < len(found):
        up_to = Window.partitionBy("_range").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        parts = counts.select("_range", "_part", F.coalesce(F.sum("_rows").over(up_to), F.lit(0)).alias("_lower"))
        joined = joined.join(parts, ["_range", "_part"]).withColumn("_before", F.col("_before") + F.col("_lower"))
    chunk = F.floor((F.col("_before") + F.col("_rank") - 1) / size) + 1
    return joined.select(*columns(df.columns), chunk.cast("long").alias("chunk"))


def _range_number(df: DataFrame, id_col: str, cuts):
    """Twice the number of cuts below the id, plus one for an id that is a cut itself."""
    if not cuts:
        return F.lit(0)
    dtype = df.schema[id_col].dataType.simpleString()
    values = F.array(*[F.lit(c) for c in cuts]).cast(f"array<{dtype}>")
    c = column(id_col)
    # A binary search over the sorted cuts: its steps halve, so the cost per row grows with the logarithm of the ranges.
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(cuts).bit_length()))])
    below = F.aggregate(steps, F.lit(0), lambda n, step: F.when(
        F.coalesce(F.get(values, n + step - 1) < c, F.lit(False)), n + step).otherwise(n))
    return F.transform(F.array(below), lambda n: 2 * n + F.coalesce(F.get(values, n) == c, F.lit(False)).cast("int"))[0]
