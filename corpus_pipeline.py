"""A text corpus from raw documents: toxicity, near duplicates, benchmark passages, source weights, shards.

Each stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and returns a DataFrame; all but the last return the
columns of ``documents``. Every stage's result is written as Parquet and read back before the next one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.llm import decontaminate, mixing, near_dedup, queries, sharding, toxicity
from tidemark.llm.common import staged


def _whole(docs: DataFrame) -> Column:
    """All columns of a row as one, so that no name of theirs can meet a name of an operator's own."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go; labels come from ``labels``.

    Null and empty texts are scored like any other. Repeated rows share their text's fate. Extra columns stay, whatever their names.
    """
    model = toxicity.ToxicityModel(docs, queries.table(spark, sf_dir, "labels"))
    scored = model.score(docs.select(_whole(docs), F.col("text").cast("string").alias("text")))
    return scored.where(F.col("score") < toxicity.THRESHOLD).select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates stays: the smallest id, no id last, then by hash of the text and of the row.

    Texts without words belong to no group and stay, repeated rows of them too. Extra columns stay, whatever their names.
    """
    key = ["_no_id", "_id", "_rk"]

    def keys(rk: Column) -> list[Column]:
        number = F.col("doc_id").cast("long")
        return [number.isNull().alias("_no_id"), F.coalesce(number, F.lit(0)).alias("_id"), rk.alias("_rk")]

    worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    place = F.row_number().over(Window.partitionBy(*key).orderBy(F.xxhash64("row")))
    single = docs.where(worded).select(_whole(docs), *keys(F.xxhash64("text"))).withColumn("_place", place).where("_place = 1")
    kept = near_dedup.NearDuplicates(docs).survivors().select(*keys(F.col("rk")))
    return single.join(kept.hint("shuffle_hash"), key, "left_semi").select("row.*").union(docs.where(~worded))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item go."""
    return decontaminate.clean_documents(docs, queries.table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources reach their target weights: a document is repeated or left out as the mixture takes it."""
    return mixing.Mixture(docs).documents()


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row gets its shard; repeats of a document share one."""
    return sharding.place(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixture", mix_sources),
    ("shards", shard),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
