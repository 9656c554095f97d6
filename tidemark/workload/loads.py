"""Increments, deduplication, merges, deletions, refreshes, snapshots and schema evolution."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from tidemark.functions.names import project, project_keys
from tidemark.functions.rows import row_hash
from tidemark.functions.times import LOOKBACK, back
from tidemark.operators import merge as m
from tidemark.operators.audit import size_check
from tidemark.operators.dedup import latest_per_key
from tidemark.operators.evolve import evolve, evolve_drop
from tidemark.operators.increment import (
    changed_since, day_text, deletes_since, last_marks_by_rule, mark_text, marks_as_of, new_mark,
)
from tidemark.operators.snapshot import hash_archive, snapshot_deletes, snapshot_diff, snapshot_diff_by_hash
from tidemark.sinks.archive import SnapshotArchive
from tidemark.sinks.storage import scratch_path
from tidemark.sinks.tables import VersionedTable, with_load_time
from tidemark.streaming.upsert import StreamAudit, drop_repeats, latest_stream, observed, read_landing, upsert_stream
from tidemark.workload import fixtures as fx
from tidemark.workload.fixtures import (
    CONTROL, FEED, LATEST, MERGED_COLUMNS, OLD_STAMP, ORDER_COLUMNS, SNAPSHOTS, STAGE, STAMP, TARGET,
    TIMED_ORDERS, merge_sql, table,
)

KEY = ["o_orderkey"]
MARK = "2000-12-31 23:50:00"  # the cut less ten minutes
LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_TIES = ["l_extendedprice", "l_partkey", "l_suppkey", "l_quantity"]


def latest_orders(df):
    return latest_per_key(df, KEY, "o_orderdate", "updt")


def merged(spark, sf_dir, strategy="auto"):
    return m.merge(fx.target(spark, sf_dir), latest_orders(fx.stage(spark, sf_dir)), KEY, STAMP, strategy)


MERGED_SQL = f"WITH {TARGET}, {STAGE}, {LATEST}, {merge_sql()} "


# -- scans and increments ----------------------------------------------------------------------------------

def scan_project(spark, sf_dir):
    return project(table(spark, sf_dir, "orders"), "o_orderkey, o_custkey, o_totalprice")


def key_projection(spark, sf_dir):
    return project_keys(table(spark, sf_dir, "lineitem"), "l_orderkey,l_linenumber")


def incr_extract(spark, sf_dir):
    return changed_since(fx.timed_orders(spark, sf_dir), MARK, "o_orderdate", "updt")


def incr_extract_deletes(spark, sf_dir):
    return deletes_since(fx.feed(spark, sf_dir), MARK, KEY, "o_orderdate")


def watermark_lookup(spark, sf_dir):
    marks = last_marks_by_rule(fx.control(spark, sf_dir), {"source": ("SOURCE_OBJECT_NAME", False), "target": ("TARGET_TABLE_NAME", True)})
    return marks.select(
        "rule", "object", "last_mark",
        mark_text(back(F.col("last_mark"))).alias("minus_10_minutes"),
        day_text(F.col("last_mark") - F.expr("INTERVAL 2 DAYS")).alias("minus_2_days"),
    )


def as_of_marks(spark, sf_dir):
    runs = fx.control(spark, sf_dir)
    by_object, by_target = marks_as_of(runs), marks_as_of(runs, "TARGET_TABLE_NAME", need_rows=True)
    return by_object.withColumn("rule", F.lit("source")).unionAll(by_target.withColumn("rule", F.lit("target")))


def new_watermark(spark, sf_dir):
    return new_mark(fx.timed_orders(spark, sf_dir), "o_orderdate", "updt", old=OLD_STAMP)


# -- latest row per key ------------------------------------------------------------------------------------

def dedup_latest(spark, sf_dir):
    return latest_per_key(fx.timed_orders(spark, sf_dir), ["o_custkey"], "o_orderdate", "updt", ["o_orderkey"])


def dedup_latest_composite(spark, sf_dir):
    return latest_per_key(table(spark, sf_dir, "lineitem"), LINE_KEY, "l_shipdate", tiebreak=LINE_TIES)


def timeless_orders(spark, sf_dir):
    """Low-priority orders carry no time at all."""
    low = F.col("o_orderpriority") == "5-LOW"
    return fx.timed_orders(spark, sf_dir).withColumns(
        {c: F.when(~low, F.col(c)) for c in ("o_orderdate", "updt")})


TIMELESS = """timeless AS (
  SELECT * REPLACE (CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderdate END AS o_orderdate,
                    CASE WHEN o_orderpriority <> '5-LOW' THEN updt END AS updt) FROM timed_orders)"""


def dedup_null_order(spark, sf_dir):
    rows = timeless_orders(spark, sf_dir)
    out = None
    for nulls in ("first", "last"):
        part = latest_per_key(rows, ["o_custkey"], "o_orderdate", "updt", ["o_orderkey"], nulls).select(
            F.lit(nulls).alias("nulls"), "o_custkey", "o_orderkey")
        out = part if out is None else out.unionAll(part)
    return out


# -- merges ------------------------------------------------------------------------------------------------

def merge_upsert(spark, sf_dir):
    return m.next_version(merged(spark, sf_dir))


def merge_upsert_shuffle(spark, sf_dir):
    return m.next_version(merged(spark, sf_dir, "shuffle"))


def merge_upsert_broadcast(spark, sf_dir):
    return m.next_version(merged(spark, sf_dir, "broadcast"))


def merge_upsert_bloom(spark, sf_dir):
    """Only target rows whose key may be in the source are shuffled."""
    return m.next_version(merged(spark, sf_dir, "bloom"))


def one_third_key(df):
    """Pending orders share one key: it holds a third of all rows."""
    return df.withColumn("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).otherwise(F.lit(-1)))


def merge_hot_key(spark, sf_dir):
    """A target and a source in which one key holds a third of the rows."""
    target = one_third_key(fx.target(spark, sf_dir))
    latest = latest_orders(one_third_key(fx.timed_orders(spark, sf_dir)))
    return m.next_version(m.merge(target, latest, KEY, STAMP, "shuffle", hot=m.hot_keys(target, KEY, floor=0)))


def merge_hot_key_bloom(spark, sf_dir):
    """A small increment into a target of which one key holds a third and null keys a tenth."""
    def odd(df):
        return keyless(one_third_key(df))

    target = odd(fx.target(spark, sf_dir))
    increment = odd(fx.timed_orders(spark, sf_dir)).where("o_orderpriority IN ('1-URGENT', '4-NOT SPECIFIED') AND o_custkey > 1000")
    return m.merge(target, latest_orders(increment), KEY, STAMP, "bloom", hot=m.hot_keys(target, KEY, floor=0))


def delete_hot_key(spark, sf_dir):
    target = one_third_key(fx.target(spark, sf_dir))
    feed = one_third_key(table(spark, sf_dir, "orders").where("o_orderpriority <> '1-URGENT'")).select("o_orderkey")
    return m.delete_by_feed(target, feed, KEY, m.hot_keys(target, KEY, floor=0))


def merge_actions(spark, sf_dir):
    return merged(spark, sf_dir).select("o_orderkey", F.col(m.ACTION).alias("action"))


def merge_counts(spark, sf_dir):
    return m.action_counts(merged(spark, sf_dir))


def changed_keys(spark, sf_dir):
    return m.changed_keys(merged(spark, sf_dir), KEY)


def keyless(df):
    """Orders without a stated priority have lost their key: about a fifth of all rows."""
    return df.withColumn("o_orderkey", F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderkey")))


def merge_null_keys(spark, sf_dir):
    target, stage = keyless(fx.target(spark, sf_dir)), keyless(fx.stage(spark, sf_dir))
    out = m.merge(target, latest_orders(stage), KEY, STAMP, "shuffle")
    return out.select("o_orderkey", "o_custkey", "o_totalprice", F.col(m.ACTION).alias("action"))


_ONE_THIRD = "SELECT * REPLACE (CASE WHEN o_orderstatus <> 'P' THEN o_orderkey ELSE -1 END AS o_orderkey)"
_KEYLESS = "SELECT * REPLACE (CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderkey END AS o_orderkey)"


def full_load_merge(spark, sf_dir):
    """Every source row is merged; target rows that the source lacks stay."""
    return m.next_version(m.merge(fx.target(spark, sf_dir), latest_orders(fx.timed_orders(spark, sf_dir)), KEY, STAMP))


def incr_load_merge(spark, sf_dir):
    """The mark comes from the target's insert times, less the lookback; the rows past it are merged."""
    target = fx.target(spark, sf_dir)
    mark = new_mark(target, "o_orderdate", "updt", insert_only=True).first()["next_mark"]
    rows = fx.timed_orders(spark, sf_dir)
    if mark is not None:
        rows = changed_since(rows, mark - LOOKBACK, "o_orderdate", "updt")
    return m.next_version(m.merge(target, latest_orders(rows), KEY, STAMP))


def merge_repeated(spark, sf_dir):
    """Merging the same stage into its own result changes nothing."""
    latest = latest_orders(fx.stage(spark, sf_dir))
    once = m.next_version(m.merge(fx.target(spark, sf_dir), latest, KEY, STAMP))
    return m.action_counts(m.merge(once, latest, KEY, "2031-01-01 00:00:00", "shuffle"))


def delete_by_feed(spark, sf_dir):
    return m.delete_by_feed(fx.target(spark, sf_dir), fx.feed(spark, sf_dir), KEY)


def delete_then_merge(spark, sf_dir):
    kept = m.delete_by_feed(fx.target(spark, sf_dir), fx.feed(spark, sf_dir), KEY)
    return m.next_version(m.merge(kept, latest_orders(fx.stage(spark, sf_dir)), KEY, STAMP))


def deleted_rows(spark, sf_dir):
    return m.deleted_rows(fx.target(spark, sf_dir), fx.feed(spark, sf_dir), KEY).select("o_orderkey", "o_totalprice")


def master_refresh(spark, sf_dir):
    return m.master_refresh(latest_orders(fx.whole_stage(spark, sf_dir)), STAMP)


def flagship(spark, sf_dir):
    """Deduplicate staged line items, merge them into the target, count the actions."""
    lines = table(spark, sf_dir, "lineitem")
    latest = latest_per_key(lines, LINE_KEY, "l_shipdate", tiebreak=LINE_TIES)
    return m.action_counts(m.merge(lineitem_target(spark, sf_dir), latest, LINE_KEY, STAMP))


def lineitem_target(spark, sf_dir):
    """What an earlier load left: lines shipped before 2000, returned ones with another tax since."""
    early = table(spark, sf_dir, "lineitem").where("l_shipdate < timestamp_ntz'2000-01-01'")
    latest = latest_per_key(early, LINE_KEY, "l_shipdate", tiebreak=LINE_TIES)
    return m.with_stamps(
        latest.withColumn("l_tax", F.when(F.col("l_returnflag") == "R", F.lit(0.0)).otherwise(F.col("l_tax"))), OLD_STAMP)


_LINE_ORDER = ("PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS FIRST, "
               "l_extendedprice DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC")


# -- snapshots ---------------------------------------------------------------------------------------------

def snap_diff(spark, sf_dir):
    return snapshot_diff(fx.new_snapshot(spark, sf_dir), fx.old_snapshot(spark, sf_dir))


def snap_diff_tree(spark, sf_dir):
    """Both snapshots archived with digests; only leaves that differ are read again."""
    archive = SnapshotArchive(spark, scratch_path(spark, "snapshots"), leaves=16)
    old = archive.write(fx.old_snapshot(spark, sf_dir))
    archive.commit(old)
    return archive.diff(archive.write(fx.new_snapshot(spark, sf_dir)), old)


def snap_diff_hash(spark, sf_dir):
    return snapshot_diff_by_hash(fx.new_snapshot(spark, sf_dir), hash_archive(fx.old_snapshot(spark, sf_dir)))


def snap_deletes(spark, sf_dir):
    return snapshot_deletes(fx.new_snapshot(spark, sf_dir), fx.old_snapshot(spark, sf_dir), ["c_custkey"])


def row_hashes(spark, sf_dir):
    c = table(spark, sf_dir, "customer").withColumn(
        "c_mktsegment", F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")))
    return c.select("c_custkey", row_hash(c, ["c_name", "c_mktsegment"]).alias("row_hash"))


# -- schema evolution --------------------------------------------------------------------------------------

def old_customers(spark, sf_dir):
    """A target from before ``c_acctbal`` came and ``legacy_code`` went; one segment was not loaded yet."""
    c = table(spark, sf_dir, "customer").where("c_mktsegment <> 'BUILDING'")
    return m.with_stamps(c.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment",
                                  F.concat(F.lit("L"), "c_custkey").alias("legacy_code")), OLD_STAMP)


def evolve_add(spark, sf_dir):
    """The new column is added, then the full source is merged so that old rows get its value."""
    source = table(spark, sf_dir, "customer")
    target, _reload = evolve(old_customers(spark, sf_dir), source.schema)
    full = source.withColumn("legacy_code", F.lit(None).cast(T.StringType()))
    return m.next_version(m.merge(target, full, ["c_custkey"], STAMP))


def evolve_drop_query(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    legacy = c.drop("c_acctbal").withColumn("legacy_code", F.concat(F.lit("L"), "c_custkey"))
    return evolve_drop(m.with_stamps(legacy, OLD_STAMP), ["LEGACY_CODE"], allow_drop=True)


# -- audit of a stage, archive, streams ---------------------------------------------------------------------

def audit_counts(spark, sf_dir):
    return size_check(fx.whole_stage(spark, sf_dir))


def archive_partition(spark, sf_dir):
    return with_load_time(fx.whole_stage(spark, sf_dir), STAMP)


def stream_upsert(spark, sf_dir):
    """The stage arrives as a stream of the orders files and is merged batch by batch into a written target."""
    home = scratch_path(spark, "stream-upsert")
    target = VersionedTable(spark, f"{home}/target")
    target.write(fx.target(spark, sf_dir))
    landing = read_landing(spark, sf_dir, table(spark, sf_dir, "orders").schema, "orders.parquet")
    days = F.make_dt_interval(F.col("o_orderkey").cast("int") % 40)
    rows = landing.withColumn("updt", F.when(F.col("o_orderstatus") != "O", F.col("o_orderdate") + days))
    staged = fx.stage_of(rows.where("o_orderstatus <> 'P'"))
    upsert_stream(staged, target, KEY, "o_orderdate", "updt", f"{home}/checkpoint", STAMP).awaitTermination()
    return target.read()


def stream_dedup(spark, sf_dir):
    """Every event arrives twice; the first arrival is kept."""
    home = scratch_path(spark, "stream-dedup")
    events = read_landing(spark, sf_dir, table(spark, sf_dir, "events").schema, "events.parquet")
    twice = events.withColumns({"ts": F.col("ts").cast("timestamp"), "_copy": F.explode(F.array(F.lit(1), F.lit(2)))})
    once = drop_repeats(twice, ["event_id"], "ts").select("event_id", "event_type", "value")
    once.writeStream.format("parquet").option("checkpointLocation", f"{home}/checkpoint").trigger(
        availableNow=True).start(f"{home}/out").awaitTermination()
    return spark.read.parquet(f"{home}/out")


def stream_latest(spark, sf_dir):
    """Orders arrive in files by priority, so in no order of time; the latest order per customer is kept throughout."""
    home = scratch_path(spark, "stream-latest")
    rows = fx.timed_orders(spark, sf_dir)
    rows.repartition(5, "o_orderpriority").write.partitionBy("o_orderpriority").parquet(f"{home}/landing")
    landing = read_landing(spark, f"{home}/landing/*", rows.drop("o_orderpriority").schema, files_per_batch=2)
    target = VersionedTable(spark, f"{home}/target")
    latest_stream(landing, target, ["o_custkey"], "o_orderdate", "updt", f"{home}/checkpoint", STAMP, tiebreak=["o_orderkey"]).awaitTermination()
    return target.read().drop(m.INSERTED, m.UPDATED)


def stream_audit(spark, sf_dir):
    """Counts of each batch, one batch per type of event, taken from the log that the run left behind.

    The types land one after another, and after each the stream goes on from its checkpoint with all files of that type. One file per
    type would take one task that sorts all events.
    """
    home = scratch_path(spark, "stream-audit")
    events = table(spark, sf_dir, "events")
    kinds = [r.event_type for r in events.select("event_type").distinct().collect()]
    rejected = F.coalesce(F.col("value") < 20, F.lit(True))
    audit = StreamAudit(spark, f"{home}/audit")
    spark.streams.addListener(audit)
    try:
        for kind in kinds:
            events.where(F.col("event_type").eqNullSafe(kind)).write.mode("append").parquet(f"{home}/landing")
            stream = read_landing(spark, f"{home}/landing", events.schema, files_per_batch=None)
            counted = observed(stream, "read", kind=F.min("event_type"), rejected=F.count_if(rejected))
            written = observed(counted.where(~rejected), "written", users=F.max("user_id"))
            query = written.writeStream.format("parquet").option("checkpointLocation", f"{home}/checkpoint").trigger(availableNow=True).start(f"{home}/out")
            query.awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(audit)
    log = spark.read.parquet(f"{home}/audit").where("rows_read > 0")
    number = {k: F.col("observed")[k].cast("long") for k in ("read.rows", "read.rejected", "written.rows", "written.users")}
    return log.select(F.col("observed")["read.kind"].alias("event_type"), "rows_read", "rows_late", number["read.rejected"].alias("rejected"),
                      number["written.rows"].alias("written"), number["written.users"].alias("last_user"))


QUERIES = {
    "scan_project": scan_project,
    "key_projection": key_projection,
    "incr_extract": incr_extract,
    "incr_extract_deletes": incr_extract_deletes,
    "watermark_lookup": watermark_lookup,
    "new_watermark": new_watermark,
    "marks_as_of": as_of_marks,
    "dedup_latest": dedup_latest,
    "dedup_latest_composite": dedup_latest_composite,
    "dedup_null_order": dedup_null_order,
    "merge_upsert": merge_upsert,
    "merge_upsert_shuffle": merge_upsert_shuffle,
    "merge_upsert_broadcast": merge_upsert_broadcast,
    "merge_upsert_bloom": merge_upsert_bloom,
    "merge_hot_key_bloom": merge_hot_key_bloom,
    "merge_hot_key": merge_hot_key,
    "merge_actions": merge_actions,
    "merge_counts": merge_counts,
    "merge_null_keys": merge_null_keys,
    "merge_repeated": merge_repeated,
    "changed_keys": changed_keys,
    "full_load_merge": full_load_merge,
    "incr_load_merge": incr_load_merge,
    "lineitem_merge_counts": flagship,
    "delete_by_feed": delete_by_feed,
    "delete_hot_key": delete_hot_key,
    "delete_then_merge": delete_then_merge,
    "deleted_rows": deleted_rows,
    "master_refresh": master_refresh,
    "snapshot_diff": snap_diff,
    "snapshot_diff_hash": snap_diff_hash,
    "snapshot_diff_tree": snap_diff_tree,
    "snapshot_deletes": snap_deletes,
    "row_hash": row_hashes,
    "evolve_add": evolve_add,
    "evolve_drop": evolve_drop_query,
    "audit_counts": audit_counts,
    "archive_partition": archive_partition,
    "stream_upsert": stream_upsert,
    "stream_dedup": stream_dedup,
    "stream_latest": stream_latest,
    "stream_audit": stream_audit,
}

_UPSERT = MERGED_SQL + f"SELECT {MERGED_COLUMNS} FROM merged"
_CUSTOMER = "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment"
_OLD_CUSTOMERS = f"""old_customers AS (
  SELECT c_custkey, c_name, c_nationkey, c_mktsegment, 'L' || CAST(c_custkey AS VARCHAR) AS legacy_code, {fx.AUDIT_SQL}
  FROM customer WHERE c_mktsegment <> 'BUILDING')"""
_SNAP_DIFF = f"""WITH {SNAPSHOTS} SELECT n.* FROM new_snapshot n WHERE NOT EXISTS (
  SELECT 1 FROM old_snapshot o WHERE {' AND '.join(f'n.{c} IS NOT DISTINCT FROM o.{c}' for c in _CUSTOMER.split(', '))})"""

_AS_OF = """SELECT r.{name} AS object, r.run_id AS RUN_ID, u.mx AS mark, '{rule}' AS rule FROM (
    SELECT *, max(CASE WHEN {usable} THEN run_id END) OVER (PARTITION BY {name} ORDER BY run_id) AS at_run FROM control) r
  LEFT JOIN control u ON u.run_id = r.at_run"""
_USABLE = f"status = 'SUCCESS' AND mx <> TIMESTAMP '{fx.SENTINEL}'"

ORACLES = {
    "marks_as_of": f"WITH {CONTROL} " + " UNION ALL ".join([
        _AS_OF.format(name="source_object", rule="source", usable=_USABLE),
        _AS_OF.format(name="target_table", rule="target", usable=_USABLE + " AND rows_inserted <> 0")]),
    "scan_project": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders",
    "key_projection": "SELECT l_orderkey, l_linenumber FROM lineitem",
    "incr_extract": f"""WITH {TIMED_ORDERS} SELECT * FROM timed_orders
        WHERE o_orderdate > TIMESTAMP '{MARK}' OR updt > TIMESTAMP '{MARK}'""",
    "incr_extract_deletes": f"WITH {FEED} SELECT o_orderkey, o_orderdate FROM feed WHERE o_orderdate > TIMESTAMP '{MARK}'",
    "watermark_lookup": f"""WITH {CONTROL}, usable AS (
          SELECT 'source' AS rule, source_object AS object, run_id, mx FROM control
          WHERE status = 'SUCCESS' AND mx <> TIMESTAMP '{fx.SENTINEL}'
          UNION ALL
          SELECT 'target', target_table, run_id, mx FROM control
          WHERE status = 'SUCCESS' AND mx <> TIMESTAMP '{fx.SENTINEL}' AND rows_inserted <> 0),
        last AS (SELECT rule, object, max_by(mx, run_id) AS last_mark FROM usable GROUP BY rule, object)
        SELECT rule, object, last_mark,
          strftime(last_mark - INTERVAL 10 MINUTE, '%Y-%m-%d %H:%M:%S.%g') AS minus_10_minutes,
          strftime(last_mark - INTERVAL 2 DAY, '%Y%m%d') AS minus_2_days FROM last""",
    "new_watermark": f"""WITH {TIMED_ORDERS} SELECT max(o_orderdate) AS max_insert, max(updt) AS max_update,
        greatest(max(o_orderdate), max(updt), TIMESTAMP '{OLD_STAMP}') AS next_mark FROM timed_orders""",
    "dedup_latest": f"""WITH {TIMED_ORDERS} SELECT {ORDER_COLUMNS} FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
        ORDER BY coalesce(updt, o_orderdate) DESC NULLS FIRST, o_orderkey DESC) AS rn FROM timed_orders) WHERE rn = 1""",
    "dedup_latest_composite": f"""SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER ({_LINE_ORDER}) AS rn FROM lineitem) WHERE rn = 1""",
    "dedup_null_order": f"""WITH {TIMED_ORDERS}, {TIMELESS}, ranked AS (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY coalesce(updt, o_orderdate) DESC NULLS FIRST, o_orderkey DESC) AS f,
                  row_number() OVER (PARTITION BY o_custkey ORDER BY coalesce(updt, o_orderdate) DESC NULLS LAST, o_orderkey DESC) AS l
        FROM timeless)
        SELECT 'first' AS nulls, o_custkey, o_orderkey FROM ranked WHERE f = 1
        UNION ALL SELECT 'last', o_custkey, o_orderkey FROM ranked WHERE l = 1""",
    "merge_upsert": _UPSERT,
    "merge_upsert_shuffle": _UPSERT,
    "merge_upsert_broadcast": _UPSERT,
    "merge_upsert_bloom": _UPSERT,
    "merge_hot_key": f"""WITH {TARGET}, htarget AS ({_ONE_THIRD} FROM target), stage AS ({_ONE_THIRD} FROM timed_orders),
        {LATEST}, {merge_sql('htarget')} SELECT {MERGED_COLUMNS} FROM merged""",
    "merge_hot_key_bloom": f"""WITH {TARGET}, htarget AS ({_ONE_THIRD} FROM target), ktarget AS ({_KEYLESS} FROM htarget),
        hstage AS ({_ONE_THIRD} FROM timed_orders),
        stage AS ({_KEYLESS} FROM hstage WHERE o_orderpriority IN ('1-URGENT', '4-NOT SPECIFIED') AND o_custkey > 1000),
        {LATEST}, {merge_sql('ktarget')} SELECT {MERGED_COLUMNS}, action AS _action FROM merged""",
    "delete_hot_key": f"""WITH {TARGET}, htarget AS ({_ONE_THIRD} FROM target),
        gone AS ({_ONE_THIRD} FROM orders WHERE o_orderpriority <> '1-URGENT')
        SELECT * FROM htarget WHERE o_orderkey NOT IN (SELECT o_orderkey FROM gone)""",
    "merge_actions": MERGED_SQL + "SELECT o_orderkey, action FROM merged",
    "merge_counts": MERGED_SQL + "SELECT action, count(*) AS rows FROM merged GROUP BY action",
    "merge_null_keys": f"""WITH {TARGET}, {STAGE.replace('stage AS', 'full_stage AS')},
        ktarget AS ({_KEYLESS} FROM target), stage AS ({_KEYLESS} FROM full_stage), {LATEST}, {merge_sql('ktarget')}
        SELECT o_orderkey, o_custkey, o_totalprice, action FROM merged""",
    "merge_repeated": MERGED_SQL + "SELECT 'keep' AS action, count(*) AS rows FROM merged",
    "changed_keys": MERGED_SQL + "SELECT o_orderkey, action AS kind FROM merged WHERE action <> 'keep'",
    "full_load_merge": f"WITH {TARGET}, {merge_sql(source='timed_orders')} SELECT {MERGED_COLUMNS} FROM merged",
    "incr_load_merge": f"""WITH {TARGET}, increment AS (SELECT * FROM timed_orders WHERE
        o_orderdate > (SELECT max(o_orderdate) - INTERVAL 10 MINUTE FROM target)
        OR updt > (SELECT max(o_orderdate) - INTERVAL 10 MINUTE FROM target)), {merge_sql(source='increment')}
        SELECT {MERGED_COLUMNS} FROM merged""",
    "lineitem_merge_counts": f"""WITH latest AS (SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER ({_LINE_ORDER}) AS rn FROM lineitem) WHERE rn = 1),
        target AS (SELECT * EXCLUDE (rn) REPLACE (CASE WHEN l_returnflag = 'R' THEN 0.0 ELSE l_tax END AS l_tax) FROM (
          SELECT *, row_number() OVER ({_LINE_ORDER}) AS rn FROM lineitem WHERE l_shipdate < TIMESTAMP '2000-01-01') WHERE rn = 1)
        SELECT CASE WHEN t.l_orderkey IS NULL THEN 'insert'
          WHEN s.l_partkey IS DISTINCT FROM t.l_partkey OR s.l_suppkey IS DISTINCT FROM t.l_suppkey
            OR s.l_quantity IS DISTINCT FROM t.l_quantity OR s.l_extendedprice IS DISTINCT FROM t.l_extendedprice
            OR s.l_discount IS DISTINCT FROM t.l_discount OR s.l_tax IS DISTINCT FROM t.l_tax
            OR s.l_returnflag IS DISTINCT FROM t.l_returnflag OR s.l_linestatus IS DISTINCT FROM t.l_linestatus
            OR s.l_shipdate IS DISTINCT FROM t.l_shipdate THEN 'update'
          ELSE 'keep' END AS action, count(*) AS rows
        FROM latest s LEFT JOIN target t ON s.l_orderkey = t.l_orderkey AND s.l_linenumber = t.l_linenumber GROUP BY 1""",
    "delete_by_feed": f"WITH {TARGET}, {FEED} SELECT * FROM target WHERE o_orderkey NOT IN (SELECT o_orderkey FROM feed)",
    "delete_then_merge": f"""WITH {TARGET}, {STAGE}, {LATEST}, {FEED},
        kept AS (SELECT * FROM target WHERE o_orderkey NOT IN (SELECT o_orderkey FROM feed)), {merge_sql('kept')}
        SELECT {MERGED_COLUMNS} FROM merged""",
    "deleted_rows": f"""WITH {TARGET}, {FEED} SELECT o_orderkey, o_totalprice FROM target
        WHERE o_orderkey IN (SELECT o_orderkey FROM feed)""",
    "master_refresh": f"""WITH {TIMED_ORDERS}, {fx.WHOLE_STAGE}, {LATEST} SELECT *, TIMESTAMP '{STAMP}' AS "EDW_INSERTED_TIMESTAMP",
        CAST(NULL AS TIMESTAMP) AS "EDW_UPDATED_TIMESTAMP" FROM latest""",
    "snapshot_diff": _SNAP_DIFF,
    "snapshot_diff_hash": _SNAP_DIFF,
    "snapshot_diff_tree": _SNAP_DIFF,
    "snapshot_deletes": f"""WITH {SNAPSHOTS} SELECT * FROM old_snapshot WHERE c_custkey NOT IN (SELECT c_custkey FROM new_snapshot)""",
    "row_hash": """SELECT c_custkey, sha256('{"c_name":"' || c_name || '","c_mktsegment":' ||
        CASE WHEN c_mktsegment <> 'BUILDING' THEN '"' || c_mktsegment || '"' ELSE 'null' END || '}') AS row_hash FROM customer""",
    "evolve_add": f"""WITH {_OLD_CUSTOMERS} SELECT c.c_custkey, c.c_name, c.c_nationkey, c.c_mktsegment,
        CAST(NULL AS VARCHAR) AS legacy_code, c.c_acctbal,
        coalesce(t."EDW_INSERTED_TIMESTAMP", TIMESTAMP '{STAMP}') AS "EDW_INSERTED_TIMESTAMP",
        CASE WHEN t.c_custkey IS NOT NULL THEN TIMESTAMP '{STAMP}' END AS "EDW_UPDATED_TIMESTAMP"
        FROM customer c LEFT JOIN old_customers t ON c.c_custkey = t.c_custkey""",
    "evolve_drop": f"SELECT * EXCLUDE (c_acctbal), {fx.AUDIT_SQL} FROM customer",
    "audit_counts": f"WITH {TIMED_ORDERS}, {fx.WHOLE_STAGE} SELECT count(*) AS rows, count(*) = 0 AS is_empty FROM stage",
    "archive_partition": f"WITH {TIMED_ORDERS}, {fx.WHOLE_STAGE} SELECT *, TIMESTAMP '{STAMP}' AS load_ts FROM stage",
    "stream_upsert": _UPSERT,
    "stream_dedup": "SELECT DISTINCT event_id, event_type, value FROM events",
    "stream_latest": f"""WITH {TIMED_ORDERS} SELECT * EXCLUDE (rn, o_orderpriority) FROM (SELECT *, row_number() OVER (
        PARTITION BY o_custkey ORDER BY coalesce(updt, o_orderdate) DESC NULLS FIRST, o_orderkey DESC) AS rn FROM timed_orders) WHERE rn = 1""",
    "stream_audit": """SELECT event_type, count(*) AS rows_read, 0::BIGINT AS rows_late, count(*) FILTER (value < 20 OR value IS NULL) AS rejected,
        count(*) FILTER (value >= 20) AS written, max(user_id) FILTER (value >= 20) AS last_user FROM events GROUP BY event_type""",
}
