"""What the operators share: word rules, written intermediate tables, connected components."""

from __future__ import annotations

import contextlib
import string

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.sinks.storage import scratch_path

GAP = r"[\x20\x09-\x0D]+"


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def split_words(text: Column, gap: str = GAP) -> Column:
    """The words between gaps; null and empty text have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), gap), lambda w: w != "")


def count_words(text: Column) -> Column:
    """Number of runs of other characters than white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


@contextlib.contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """Arrow batches of so many rows while an own intermediate table is written, so that Python tasks stay small."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def staged(df: DataFrame, label: str, rows: int = 1000) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, safe from lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with arrow_rows(spark, rows):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """Connected components of ``links`` (a, b long) as (node, root), root being the smallest node of the component.

    Alternating large and small stars: each round points every node at the smallest node it knows of, so the number of
    rounds grows with the logarithm of the longest chain. A node with very many links costs one partial minimum per task
    and a join that Spark may split; nothing is gathered per node. Nodes without links are not returned.
    """
    edges = staged(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), label)
    before = None
    while True:
        # Large star: every neighbour above a node goes to the smallest node of its neighbourhood.
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        # Small star: every node below goes to the smallest one below.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.*").where("u != v").distinct())
        edges = staged(small, label)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now
