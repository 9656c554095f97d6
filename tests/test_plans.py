"""Physical plans: what must be pushed, shared, limited or absent."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidemark.operators import merge as m
from tidemark.operators.dedup import latest_per_key
from tidemark.operators.increment import changed_since
from tidemark.operators.snapshot import snapshot_diff
from tidemark.sinks.tables import VersionedTable
from tidemark.workload import fixtures as fx, loads


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def plan(df, mode="simple"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


LAZY = sorted(n for n in entry.queries() if not n.startswith("stream_"))


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python(spark, sf_dir, name):
    text = plan(entry.queries()[name](spark, sf_dir))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert word not in text


def test_increment_is_pushed_to_the_scan(spark, sf_dir):
    text = plan(changed_since(fx.table(spark, sf_dir, "orders"), "2001-01-01 00:00:00", "o_orderdate").select("o_orderkey"), "formatted")
    assert re.search(r"PushedFilters: .*GreaterThan\(o_orderdate", text)
    assert re.search(r"ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>", text)


def test_two_column_increment_is_one_pushed_or(spark, sf_dir, tmp_path):
    fx.timed_orders(spark, sf_dir).write.parquet(f"{tmp_path}/orders")
    text = plan(changed_since(spark.read.parquet(f"{tmp_path}/orders"), loads.MARK, "o_orderdate", "updt"), "formatted")
    assert re.search(r"PushedFilters: \[Or\(GreaterThan\(o_orderdate,.*GreaterThan\(updt,", text)


def test_keys_are_limited_before_the_shuffle(spark, sf_dir):
    text = plan(loads.dedup_latest_composite(spark, sf_dir))
    partial, exchange, final = text.index("Partial"), text.index("Exchange"), text.index("Final")
    assert "WindowGroupLimit" in text and final < exchange < partial  # printed top-down
    assert text.count("Exchange hashpartitioning") == 1


def test_merge_shuffles_each_side_once(spark, sf_dir, no_broadcast):
    # null-key branch of the target needs no shuffle; that of the source has its own small one
    text = plan(loads.merge_upsert_shuffle(spark, sf_dir))
    assert text.count("SortMergeJoin") == 1
    assert text.count("Exchange hashpartitioning") == 3


def test_bloom_merge_shuffles_only_what_may_match(spark, tmp_path, no_broadcast):
    target = spark.range(100_000).selectExpr("id AS k", "id * 2 AS v", "CAST(NULL AS TIMESTAMP_NTZ) AS EDW_INSERTED_TIMESTAMP",
                                             "CAST(NULL AS TIMESTAMP_NTZ) AS EDW_UPDATED_TIMESTAMP")
    target.write.parquet(f"{tmp_path}/target")
    spark.range(99_500, 100_500).selectExpr("id AS k", "id AS v").write.parquet(f"{tmp_path}/source")
    target, source = spark.read.parquet(f"{tmp_path}/target"), spark.read.parquet(f"{tmp_path}/source")
    merged = m.merge(target, source, ["k"], "2030-01-01 00:00:00", "bloom")
    text = plan(merged)
    assert text.count("BroadcastHashJoin") == 2 and text.count("SortMergeJoin") == 1 and text.count("Exchange hashpartitioning") == 2
    assert m.key_filter(source, ["k"]).mark(target, ["k"]).where("_maybe").count() < 500 + 0.02 * 100_000
    assert {r.action: r.rows for r in m.action_counts(merged).collect()} == {"keep": 99_500, "update": 500, "insert": 500}


def test_strategy_follows_the_sizes(spark, tmp_path):
    spark.range(200_000).write.parquet(f"{tmp_path}/target")
    spark.range(2_000).write.parquet(f"{tmp_path}/source")
    target, source = spark.read.parquet(f"{tmp_path}/target"), spark.read.parquet(f"{tmp_path}/source")
    assert m.choose_strategy(target, source) == "broadcast" and m.choose_strategy(source, target) == "shuffle"
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        assert m.choose_strategy(target, source) == "bloom"
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_null_filter_reaches_the_scan(spark, sf_dir):
    assert "IsNull(o_orderkey)" in plan(loads.merge_upsert_shuffle(spark, sf_dir), "formatted")


def test_small_source_leaves_the_target_unshuffled(spark, tmp_path):
    spark.range(200_000).select("id", F.col("id").cast("string").alias("v")).write.parquet(f"{tmp_path}/t")
    spark.range(1000).select("id", F.lit("x").alias("v")).write.parquet(f"{tmp_path}/s")
    target = m.with_stamps(spark.read.parquet(f"{tmp_path}/t"), "2020-01-01 00:00:00")
    source = spark.read.parquet(f"{tmp_path}/s")
    assert m.choose_strategy(target, source) == "broadcast"
    assert m.choose_strategy(source, target) == "shuffle"
    text = plan(m.merge(target, source, ["id"], "2030-01-01 00:00:00"))
    assert "BroadcastHashJoin" in text and "LeftOuter" in text and "FullOuter" not in text


def test_hot_rows_meet_a_broadcast(spark, sf_dir, no_broadcast):
    text = plan(loads.merge_hot_key(spark, sf_dir))
    assert re.search(r"BroadcastHashJoin \[.*\], LeftOuter", text)
    assert re.search(r"SortMergeJoin \[.*\], FullOuter", text)


def test_snapshot_diff_is_one_aggregation(spark, sf_dir):
    text = plan(snapshot_diff(fx.new_snapshot(spark, sf_dir), fx.old_snapshot(spark, sf_dir)))
    assert "Join" not in text and "partial_sum" in text


def test_copies_are_dealt_out_to_all_tasks(spark):
    """One row copied often: every task writes a share, and both branches read one shuffle."""
    new = spark.range(0, 400_000, 1, 4).selectExpr("if(id % 2 = 0, -1, id) AS k")
    diff = snapshot_diff(new, spark.range(1).toDF("k"))
    shares = diff.where("k = -1").groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in shares) == 200_000 and max(r["count"] for r in shares) <= 60_000
    diff.collect()
    final = diff._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in final


def test_bucketed_target_is_not_shuffled(spark, tmp_path, no_broadcast):
    rows = spark.range(1000).select(F.col("id").alias("k"), F.lit(1.0).alias("v"), F.lit(None).cast("timestamp_ntz").alias("ins"))
    table = VersionedTable(spark, f"{tmp_path}/bucketed_{tmp_path.name}", ["k"], buckets=8)
    table.write(m.with_stamps(rows, "2020-01-01 00:00:00"))
    latest = latest_per_key(rows.withColumn("v", F.col("v") + F.col("k") % 2), ["k"], "ins")
    merged = m.merge(table.read(), latest, ["k"], "2030-01-01 00:00:00", "shuffle", null_keys="reject")
    text = plan(merged)
    assert text.count("Exchange hashpartitioning") == 1  # the source's own
    assert table.write(m.next_version(merged)) == 2
    assert table.read().where(F.col(m.UPDATED).isNotNull()).count() == 500
