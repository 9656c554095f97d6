"""The stream must end where the batch ends."""

from pyspark.sql import functions as F

from tidemark.operators import merge as m
from tidemark.operators.dedup import latest_per_key
from tidemark.sinks.tables import VersionedTable
from tidemark.streaming.upsert import StreamAudit, drop_repeats, latest_stream, observed, read_landing, upsert_stream

STAMP = "2030-01-01 00:00:00"
SCHEMA = "k long, v long, ins timestamp_ntz, upd timestamp_ntz"


def rows(spark, start, end, shift_days, factor):
    day = F.make_dt_interval(F.lit(shift_days))
    return spark.range(start, end).select(
        F.col("id").alias("k"), (F.col("id") * factor).alias("v"), (F.lit("2024-01-01").cast("timestamp_ntz") + day).alias("ins"),
        F.lit(None).cast("timestamp_ntz").alias("upd"))


def bag(df):
    return sorted(tuple(map(str, r)) for r in df.select("k", "v", "ins").collect())


def test_batches_in_any_order_end_like_one_batch(spark, tmp_path):
    parts = [rows(spark, 0, 50, 1, 1), rows(spark, 30, 80, 5, 2), rows(spark, 20, 60, 3, 3)]
    for p in parts:
        p.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    table = VersionedTable(spark, f"{tmp_path}/target")

    def run():
        stream = read_landing(spark, f"{tmp_path}/in", SCHEMA, files_per_batch=1)
        q = upsert_stream(stream, table, ["k"], "ins", "upd", f"{tmp_path}/checkpoint", STAMP)
        q.awaitTermination()
        return q

    run()
    whole = parts[0].unionAll(parts[1]).unionAll(parts[2])
    want = bag(latest_per_key(whole, ["k"], "ins", "upd"))
    assert bag(table.read()) == want
    assert table.current() == 4 and len(table.versions()) == 2
    # nothing new: nothing happens; one more file: only that is merged
    run()
    assert table.current() == 4
    rows(spark, 70, 90, 9, 7).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    run()
    assert table.current() == 5 and table.read().where("k = 85").first()["v"] == 595


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    rows(spark, 0, 10, 1, 1).write.parquet(f"{tmp_path}/in")
    table = VersionedTable(spark, f"{tmp_path}/target")
    for attempt in (1, 2):  # a lost checkpoint replays everything
        stream = read_landing(spark, f"{tmp_path}/in", SCHEMA)
        upsert_stream(stream, table, ["k"], "ins", "upd", f"{tmp_path}/checkpoint{attempt}", f"203{attempt}-01-01 00:00:00").awaitTermination()
    assert table.read().where(F.col(m.UPDATED).isNotNull()).count() == 0
    assert table.read().count() == 10


def test_first_arrival_wins_and_batches_are_logged(spark, tmp_path):
    audit = StreamAudit()
    spark.streams.addListener(audit)
    for _ in range(2):
        rows(spark, 0, 10, 1, 1).withColumn("ins", F.col("ins").cast("timestamp")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = read_landing(spark, f"{tmp_path}/in", "k long, v long, ins timestamp, upd timestamp_ntz", files_per_batch=1)
    q = drop_repeats(stream, ["k"], "ins").writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/c").trigger(
        availableNow=True).start(f"{tmp_path}/out")
    q.awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 10
    import time

    for _ in range(50):
        if sum(n for _, n, _ in audit.batches) >= 20:
            break
        time.sleep(0.1)
    spark.streams.removeListener(audit)
    assert sum(n for _, n, _ in audit.batches) == 20 and not audit.errors


def test_latest_row_of_files_in_any_order(spark, tmp_path):
    """Late files change nothing, null times win, null keys stay out, and a flooding key is one row per task before the shuffle."""
    parts = [rows(spark, 0, 50, 9, 1), rows(spark, 30, 80, 5, 2), rows(spark, 20, 60, 3, 3)]
    flood = rows(spark, 0, 4000, 1, 1).withColumn("k", F.lit(7).cast("long"))
    odd = rows(spark, 0, 3, 1, 5).withColumns({"ins": F.when(F.col("k") > 0, F.col("ins")), "k": F.when(F.col("k") < 2, F.col("k"))})
    parts = [*parts, flood, odd]
    for p in parts:
        p.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    table = VersionedTable(spark, f"{tmp_path}/target")
    query = latest_stream(read_landing(spark, f"{tmp_path}/in", SCHEMA, files_per_batch=1), table, ["k"], "ins", "upd", f"{tmp_path}/c", STAMP)
    query.awaitTermination()
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionAll(p)
    assert bag(table.read()) == bag(latest_per_key(whole.where("k IS NOT NULL"), ["k"], "ins", "upd"))
    assert table.read().where("k = 0").first()["ins"] is None
    states = [s for p in query.recentProgress for s in p["stateOperators"]]
    assert max(s["numRowsTotal"] for s in states) == 80 and max(s["numRowsUpdated"] for s in states) <= 50


def test_batches_are_counted_in_the_pass_that_writes_them(spark, tmp_path):
    for start in (0, 10):
        rows(spark, start, start + 10, 1, 1).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    audit = StreamAudit(spark, f"{tmp_path}/audit")
    spark.streams.addListener(audit)
    stream = observed(read_landing(spark, f"{tmp_path}/in", SCHEMA, files_per_batch=1), "read", odd=F.count_if(F.col("k") % 2 == 1))
    out = observed(stream.where("k <> 3"), "written")
    try:
        out.writeStream.queryName("counted").format("parquet").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start(
            f"{tmp_path}/out").awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(audit)
    log = spark.read.parquet(f"{tmp_path}/audit").where("rows_read > 0").collect()
    assert {r.query for r in log} == {"counted"} and len({r.batch_id for r in log}) == 2
    assert sorted(tuple(r.observed[k] for k in ("read.rows", "read.odd", "written.rows")) for r in log) in ([("10", "5", "10"), ("10", "5", "9")], [("10", "5", "9"), ("10", "5", "10")])


def test_a_type_is_one_batch_of_many_files(spark, tmp_path, monkeypatch):
    """One file per type came from one task that sorted all events."""
    from tidemark.workload import loads
    from tidemark.workload.fixtures import table

    kind = F.when(F.col("id") % 10 != 0, F.concat(F.lit("kind"), F.col("id") % 3))
    spark.range(0, 400, 1, 4).select(
        (F.col("id") % 390).alias("event_id"), F.lit("2024-01-01").cast("timestamp_ntz").alias("ts"), (F.col("id") % 50).alias("user_id"), kind.alias("event_type"),
        F.when(F.col("id") % 7 != 0, (F.col("id") % 40).cast("double")).alias("value"), F.lit("{}").alias("props")).write.parquet(f"{tmp_path}/in/events.parquet")
    monkeypatch.setattr(loads, "scratch_path", lambda spark, label: f"{tmp_path}/{label}")
    got = loads.stream_audit(spark, f"{tmp_path}/in")
    kept = F.col("value") >= 20
    want = table(spark, f"{tmp_path}/in", "events").groupBy("event_type").agg(
        F.count(F.lit(1)), F.lit(0), F.count_if(~F.coalesce(kept, F.lit(False))), F.count_if(kept), F.max(F.when(kept, F.col("user_id"))))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, map(tuple, want.collect())))
    log = spark.read.parquet(f"{tmp_path}/stream-audit/audit").where("rows_read > 0").collect()
    assert len(log) == 4 and len({r.batch_id for r in log}) == 4 and len({r.query for r in log}) == 1
    landed = spark.read.parquet(f"{tmp_path}/stream-audit/landing").select("event_type", F.input_file_name().alias("file")).distinct()
    assert [r["count"] for r in landed.groupBy("event_type").count().collect()] == [4] * 4
    assert spark.read.parquet(f"{tmp_path}/stream-audit/out").count() == sum(r.written for r in got.collect())
