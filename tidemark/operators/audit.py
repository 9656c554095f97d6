"""The control table: one row per run of one object."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

_N, _L, _S = T.TimestampNTZType(), T.LongType(), T.StringType()

# The columns of the control table.
CONTROL_SCHEMA = T.StructType([
    T.StructField("RUN_ID", _L), T.StructField("RUN_START", _N), T.StructField("RUN_END", _N),
    T.StructField("DURATION_IN_SEC", T.DoubleType()), T.StructField("IP_ADDRESS", _S),
    T.StructField("SOURCE_DATABASE_NAME", _S), T.StructField("SOURCE_SCHEMA_NAME", _S),
    T.StructField("SOURCE_OBJECT_NAME", _S), T.StructField("TARGET_DATABASE_NAME", _S),
    T.StructField("TARGET_SCHEMA_NAME", _S), T.StructField("TARGET_TABLE_NAME", _S),
    T.StructField("TRIGGERED_BY", _S), T.StructField("STATUS", _S), T.StructField("ERROR_MESSAGE", _S),
    T.StructField("ROWS_INSERTED_IDS", _S), T.StructField("ROWS_INSERTED", _L),
    T.StructField("ROWS_UPDATED_IDS", _S), T.StructField("ROWS_UPDATED", _L),
    T.StructField("ROWS_DELETED", _L), T.StructField("MAX_TIMESTAMP", _N),
    T.StructField("CREATED_TIMESTAMP", _N), T.StructField("CREATED_BY", _S),
])


def run_summary(control: DataFrame) -> DataFrame:
    """Per target table: runs, failures, seconds, rows, latest usable mark. One pass, combined map-side."""
    from tidemark.functions.times import SENTINEL, ntz

    ok = F.col("STATUS") == "SUCCESS"
    usable = ok & (F.col("MAX_TIMESTAMP") != ntz(SENTINEL))
    return control.groupBy(F.col("TARGET_TABLE_NAME").alias("table_name")).agg(
        F.count(F.lit(1)).alias("runs"),
        F.count_if(F.col("STATUS") == "FAILED").alias("failures"),
        F.coalesce(F.sum("ROWS_INSERTED"), F.lit(0)).cast("long").alias("rows_inserted"),
        F.max_by(F.when(usable, F.col("MAX_TIMESTAMP")), F.when(usable, F.col("RUN_ID"))).alias("last_mark"),
    )


def run_seconds(start, end):
    """Run time in seconds with fraction."""
    return (F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / F.lit(1e6)


def failures(control: DataFrame, since_run_id: int = 0) -> DataFrame:
    """Failed objects and reasons of the runs after ``since_run_id``, for a status report."""
    return control.where((F.col("STATUS") == "FAILED") & (F.col("RUN_ID") > since_run_id)).select(
        "RUN_ID", "SOURCE_OBJECT_NAME", "ERROR_MESSAGE")


def size_check(df: DataFrame) -> DataFrame:
    """Row count and emptiness in one pass."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("is_empty", F.col("rows") == 0)
