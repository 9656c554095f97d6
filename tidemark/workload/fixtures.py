"""Load situations derived from the whole given tables, once for Spark and once as SQL.

Which rows a target or a stage holds follows from dates, states and segments, as in a real load.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.times import SENTINEL, ntz
from tidemark.operators.merge import with_stamps

STAMP = "2030-01-01 00:00:00"
OLD_STAMP = "2020-01-01 00:00:00"
CUT = "2001-01-01 00:00:00"

AUDIT_SQL = f"TIMESTAMP '{OLD_STAMP}' AS \"EDW_INSERTED_TIMESTAMP\", CAST(NULL AS TIMESTAMP) AS \"EDW_UPDATED_TIMESTAMP\""


# Declared, so that opening a table runs no job over its files.
SCHEMAS = {
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
              "o_orderpriority string",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


# -- orders with an update time: open orders were never updated ------------------------------------------

ORDER_COLUMNS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, updt"


def timed_orders(spark, sf_dir) -> DataFrame:
    days = F.make_dt_interval(F.col("o_orderkey").cast("int") % 40)
    return table(spark, sf_dir, "orders").withColumn(
        "updt", F.when(F.col("o_orderstatus") != "O", F.col("o_orderdate") + days))


TIMED_ORDERS = """timed_orders AS (
  SELECT *, CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + (o_orderkey % 40) * INTERVAL 1 DAY END AS updt
  FROM orders)"""


# -- a target loaded before the cut ------------------------------------------------------------------------

def target(spark, sf_dir) -> DataFrame:
    return with_stamps(timed_orders(spark, sf_dir).where(F.col("o_orderdate") < ntz(CUT)), OLD_STAMP)


TARGET = f"""{TIMED_ORDERS}, target AS (
  SELECT *, {AUDIT_SQL} FROM timed_orders WHERE o_orderdate < TIMESTAMP '{CUT}')"""


# -- a stage of open and filled orders: filled ones cost 10 more, and an older state of them lies beside -----

def stage(spark, sf_dir) -> DataFrame:
    rows = timed_orders(spark, sf_dir).where("o_orderstatus <> 'P'")
    return stage_of(rows)


def whole_stage(spark, sf_dir) -> DataFrame:
    """The same with pending orders."""
    return stage_of(timed_orders(spark, sf_dir))


def stage_of(rows: DataFrame) -> DataFrame:
    filled = F.col("o_orderstatus") == "F"
    states = F.when(filled, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    copies = rows.withColumn("_age", F.explode(states))
    return copies.withColumns({
        "o_totalprice": F.when(filled, F.col("o_totalprice") + 10 - 5 * F.col("_age")).otherwise(F.col("o_totalprice")),
        "updt": F.col("updt") - F.make_dt_interval(F.col("_age")),
    }).drop("_age")


STAGE = f"""stage AS (
  SELECT * REPLACE (CASE WHEN o_orderstatus = 'F' THEN o_totalprice + 10 ELSE o_totalprice END AS o_totalprice)
  FROM timed_orders WHERE o_orderstatus <> 'P'
  UNION ALL
  SELECT * REPLACE (o_totalprice + 5 AS o_totalprice, updt - INTERVAL 1 DAY AS updt)
  FROM timed_orders WHERE o_orderstatus = 'F')"""

WHOLE_STAGE = STAGE.replace(" WHERE o_orderstatus <> 'P'", "")

LATEST = f"""latest AS (
  SELECT {ORDER_COLUMNS} FROM (
    SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY coalesce(updt, o_orderdate) DESC NULLS FIRST,
      o_custkey DESC, o_orderstatus DESC, o_totalprice DESC, o_orderdate DESC, o_orderpriority DESC) AS rn
    FROM stage) WHERE rn = 1)"""


def merge_sql(target_name: str = "target", source: str = "latest") -> str:
    """Next version of an orders target, with the action of each row."""
    names = [c.strip() for c in ORDER_COLUMNS.split(",")]
    changed = " OR ".join(f"s.{c} IS DISTINCT FROM t.{c}" for c in names)
    new = f"TIMESTAMP '{STAMP}'"
    picked = ", ".join(f"CASE WHEN action = 'keep' THEN t_{c} ELSE s_{c} END AS {c}" for c in names)
    return f"""joined AS (
  SELECT {', '.join(f't.{c} AS t_{c}' for c in names)}, {', '.join(f's.{c} AS s_{c}' for c in names)},
    t."EDW_INSERTED_TIMESTAMP" AS ins, t."EDW_UPDATED_TIMESTAMP" AS upd,
    CASE WHEN t.is_t IS NULL THEN 'insert' WHEN s.is_s IS NULL THEN 'keep' WHEN {changed} THEN 'update' ELSE 'keep' END AS action
  FROM (SELECT *, 1 AS is_t FROM {target_name}) t FULL OUTER JOIN (SELECT *, 1 AS is_s FROM {source}) s
    ON t.o_orderkey = s.o_orderkey),
merged AS (
  SELECT {picked},
    CASE WHEN action = 'insert' THEN {new} ELSE ins END AS "EDW_INSERTED_TIMESTAMP",
    CASE WHEN action = 'update' THEN {new} ELSE upd END AS "EDW_UPDATED_TIMESTAMP", action
  FROM joined)"""


MERGED_COLUMNS = f'{ORDER_COLUMNS}, "EDW_INSERTED_TIMESTAMP", "EDW_UPDATED_TIMESTAMP"'


# -- a deletion feed: cancelled low-priority orders ----------------------------------------------------------

def feed(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").where("o_orderpriority = '5-LOW'").select("o_orderkey", "o_orderdate")


FEED = "feed AS (SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderpriority = '5-LOW')"


# -- a control log: every event is a run of the object named by its type --------------------------------------

def control(spark, sf_dir) -> DataFrame:
    failed = F.col("value") < 5
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("RUN_ID"),
        F.col("event_type").alias("SOURCE_OBJECT_NAME"),
        F.upper("event_type").alias("TARGET_TABLE_NAME"),
        F.when(failed, "FAILED").otherwise("SUCCESS").alias("STATUS"),
        F.when(failed | (F.col("value") > 60), ntz(SENTINEL)).otherwise(F.col("ts")).alias("MAX_TIMESTAMP"),
        (F.col("user_id") % 7).alias("ROWS_INSERTED"),
        F.col("ts").alias("RUN_START"),
        (F.col("ts") + F.make_dt_interval(mins=F.col("user_id").cast("int"))).alias("RUN_END"),
    )


CONTROL = f"""control AS (
  SELECT event_id AS run_id, event_type AS source_object, upper(event_type) AS target_table,
    CASE WHEN value < 5 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
    CASE WHEN value < 5 OR value > 60 THEN TIMESTAMP '{SENTINEL}' ELSE ts END AS mx,
    user_id % 7 AS rows_inserted, ts AS run_start, ts + user_id * INTERVAL 1 MINUTE AS run_end
  FROM events)"""


# -- two snapshots of customers: one segment gone, one new and doubled, one changed ---------------------------

def old_snapshot(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").where("c_mktsegment <> 'BUILDING'")


def new_snapshot(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer").where("c_mktsegment <> 'MACHINERY'")
    changed = c.withColumn(
        "c_acctbal", F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")))
    copies = F.when(F.col("c_mktsegment") == "BUILDING", F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return changed.withColumn("_copy", F.explode(copies)).drop("_copy")


SNAPSHOTS = """old_snapshot AS (SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING'),
new_snapshot AS (
  SELECT * REPLACE (CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal)
  FROM customer WHERE c_mktsegment <> 'MACHINERY'
  UNION ALL SELECT * FROM customer WHERE c_mktsegment = 'BUILDING')"""


# -- documents: every event as JSON text ---------------------------------------------------------------------

def documents(spark, sf_dir) -> DataFrame:
    """(event_id, body); errors were never updated, balances are text by the time a document is staged, and the
    body's keys are not sorted."""
    e = table(spark, sf_dir, "events")
    return e.select("event_id", document_text(F.col("value")).alias("body"))


def document_text(balance, updated=None, sort_keys=False):
    """JSON text of an event; with sorted keys it is what a loaded target holds."""
    updated = F.when(F.col("event_type") != "error", F.col("ts") + F.expr("INTERVAL 1 DAY")) if updated is None else updated
    fields = {
        "wallet": F.struct(balance.cast("string").alias("balance")),
        "_id": F.col("event_id").cast("string"),
        "createdAt": F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
        "updatedAt": F.date_format(updated, "yyyy-MM-dd HH:mm:ss.SSSSSS"),
        "props": F.from_json("props", "k long"),
    }
    names = sorted(fields) if sort_keys else list(fields)
    return F.to_json(F.struct(*[fields[n].alias(n) for n in names]))


DOCUMENTS = """docs AS (
  SELECT event_id, CAST(event_id AS VARCHAR) AS id, ts AS created,
    CASE WHEN event_type <> 'error' THEN ts + INTERVAL 1 DAY END AS updated, value, user_id, event_type,
    json_extract_string(props, '$.k') AS k
  FROM events)"""


def canonical_sql(balance: str, created: str = "created", updated: str = "updated") -> str:
    """Document text with sorted keys; a missing update time is left out."""
    f = "'%Y-%m-%d %H:%M:%S.%f'"
    return (
        f"'{{\"_id\":\"' || id || '\",\"createdAt\":\"' || strftime({created}, {f}) || '\",\"props\":{{\"k\":' || k || '}}' || "
        f"coalesce(',\"updatedAt\":\"' || strftime({updated}, {f}) || '\"', '') || ',\"wallet\":{{\"balance\":\"' || {balance} || '\"}}}}'"
    )
