"""Registered queries over what lands and what is logged: rejects, entity pages, stages, control rows, catalogs, types of all systems."""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F, types as T

from tidemark.functions.typemap import TypeMap, lookup
from tidemark.operators.audit import CONTROL_SCHEMA
from tidemark.operators.scan import Blocks
from tidemark.plans.loader import Extract, Loader, Outcome
from tidemark.sinks.storage import scratch_path
from tidemark.sinks.tables import read_stage, write_stage
from tidemark.sources import catalog as cat, documents, odata
from tidemark.spec import JobSpec, read_jobs
from tidemark.workload import fixtures as fx
from tidemark.workload.columns import as_text
from tidemark.workload.fixtures import table


def doc_rejects(spark, sf_dir):
    """Lines of which every seventh user's are cut off before their end: broken ones are told apart and counted."""
    whole = table(spark, sf_dir, "events").select("event_type", "user_id", fx.document_text(F.col("value")).alias("text"))
    cut = F.expr("left(text, length(text) - 1)")
    lines = whole.select("event_type", F.when(F.col("user_id") % 7 == 0, cut).otherwise(F.col("text")).alias("line"))
    return lines.groupBy("event_type").agg(F.count_if(documents.broken(F.col("line"))).alias("rejected"), F.count("*").alias("lines"))


def entity_pages(e, size: int = 500):
    """(user_id, page): each user's events as JSON texts of about ``size`` entities; rows are dealt to a user's pages by their number."""
    of_user = e.groupBy(F.col("user_id").alias("_user")).agg(F.ceil(F.count("*") / size).alias("_pages"))
    dealt = e.withColumn("_row", F.monotonically_increasing_id()).join(of_user, F.col("user_id").eqNullSafe(F.col("_user")))
    page = F.pmod(F.xxhash64("_row"), F.col("_pages")).alias("_page")
    entity = F.struct(F.col("event_id").cast("string").alias("Id"), F.col("value").cast("string").alias("Amount"),
                      F.concat(F.lit("/Date("), F.unix_millis(F.col("ts").cast("timestamp")).cast("string"), F.lit(")/")).alias("At"))
    pages = dealt.groupBy("user_id", page).agg(F.to_json(F.struct(F.struct(F.collect_list(entity).alias("results")).alias("d"))).alias("page"))
    return pages.select("user_id", "page")


def odata_pages_flatten(spark, sf_dir):
    """Pages of entities as JSON text, each of one user and of bounded size, exploded and typed by their catalog."""
    pages = entity_pages(table(spark, sf_dir, "events"))
    read = F.from_json("page", "d struct<results: array<struct<Id: string, Amount: string, At: string>>>")
    rows = odata.flatten_entities(pages.select(F.explode(read["d"]["results"]).alias("e")).select("e.*"))
    typed = odata.typed_entities(rows, [("Id", "Edm.Int64"), ("Amount", "Edm.Double"), ("At", "Edm.DateTime")], TypeMap())
    return typed.select(F.col("Id").alias("id"), F.col("Amount").alias("amount"), F.col("At").alias("at"))


def stage_roundtrip(spark, sf_dir):
    """All orders staged as one run and read back."""
    orders = table(spark, sf_dir, "orders")
    folder = scratch_path(spark, "stage-roundtrip")
    write_stage(orders, folder, "20300101T000000")
    return read_stage(spark, folder, schema=orders.schema)


def control_append(spark, sf_dir):
    """A run per day and order priority, logged in one append with the number of its orders, read back and added up by target."""
    loader = Loader(spark, scratch_path(spark, "control-append"), {}, target_name=("WAREHOUSE", "PUBLIC"))
    loader._ensure_control()
    start = loader.clock()
    job = JobSpec(**{**dict.fromkeys(JobSpec.__dataclass_fields__), "src_db_name": "postgresql", "obj_type": "table", "obj_name": "-", "sf_tbl": "-"})
    row = loader._audit_row(Outcome(job, "SUCCESS"), start, start + timedelta(seconds=90), 0)
    found = table(spark, sf_dir, "orders").groupBy("o_orderpriority", "o_orderdate").count().withColumn("_all", F.lit(0))
    found = Blocks(found, ["_all"], ["o_orderpriority", "o_orderdate"], label="control-runs").running(_run=("sum", F.lit(1))).rows()
    own = {"RUN_ID": F.col("_run"), "ROWS_INSERTED": F.col("count"),
           "SOURCE_OBJECT_NAME": F.col("o_orderpriority"), "TARGET_TABLE_NAME": F.upper("o_orderpriority")}
    loader._append(found.select(*(own.get(f.name, F.lit(row.get(f.name))).cast(f.dataType).alias(f.name) for f in CONTROL_SCHEMA.fields)))
    by_target = loader.control().groupBy(F.col("TARGET_TABLE_NAME").alias("target_table"), F.col("STATUS").alias("status")).agg(
        F.min("RUN_ID").alias("first"), F.sum("ROWS_INSERTED").alias("rows_inserted"), F.max("DURATION_IN_SEC").alias("seconds"))
    run = F.row_number().over(Window.orderBy("first")).cast("long")  # one row per target
    return by_target.select(run.alias("run_id"), "target_table", "status", "rows_inserted", "seconds")


def _job_table(spark, rows) -> str:
    """``rows`` of a job table (upper-case headers) as CSV files."""
    folder = scratch_path(spark, "jobs")
    rows.write.option("header", True).csv(folder)
    return folder


def job_table(spark, sf_dir):
    """A job per type of part, as files with gaps (``-``, blanks, absent columns), read back as what the loader goes by."""
    of_type = table(spark, sf_dir, "part").groupBy("p_type").agg(F.count("*").alias("n"), F.min("p_size").alias("low"))
    jobs = read_jobs(spark, _job_table(spark, of_type.select(
        F.col("p_type").alias("OBJ_NAME"), F.concat(F.lit("T_"), "p_type").alias("SF_TBL"), F.lit(" p_partkey , p_brand").alias("PRIMARY_KEY_COL"),
        F.when(F.col("n") % 2 == 0, "FILE").otherwise("table").alias("OBJ_TYPE"), F.when(F.col("n") % 3 == 0, "Yes").otherwise("-").alias("MASTER_TBL"),
        F.when(F.col("low") % 2 == 0, "yes").otherwise(" ").alias("IS_DELETION"))))
    rows = [(j.obj_name, j.sf_tbl, ",".join(j.keys), j.is_file, j.is_master, j.deletes, j.client) for j in jobs]  # one per object, as the loader holds them
    return spark.createDataFrame(rows, "object string, target string, keys string, is_file boolean, is_master boolean, deletes boolean, client string")


def load_outcomes(spark, sf_dir):
    """One full load over a job table: the orders of each status, one object without rows, one whose values do not fit their type.

    The failing object is logged and stops no other, the empty one leaves an empty target. Prices are decimal by override.
    """
    orders = table(spark, sf_dir, "orders")

    def reader(session, job, mark):
        if job.obj_name == "broken":
            schema = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_orderpriority", T.IntegerType())])
            return Extract(orders.select("o_orderkey", F.concat("o_orderpriority", F.lit("!")).alias("o_orderpriority")), schema)
        return orders.where(F.col("o_orderstatus") == job.obj_name)

    status = orders.select(F.col("o_orderstatus").alias("OBJ_NAME")).distinct()
    names = status.union(spark.createDataFrame([("none",), ("broken",)], "OBJ_NAME string"))
    given = {"SRC_DB_NAME": "postgresql", "OBJ_TYPE": "table", "PRIMARY_KEY_COL": "o_orderkey", "INSRT_TIME_COL": "o_orderdate", "COL_NAMES": "*"}
    folder = _job_table(spark, names.select("OBJ_NAME", F.concat(F.lit("T_"), "OBJ_NAME").alias("SF_TBL"),
                                            *[F.lit(v).alias(k) for k, v in given.items()]))
    kinds = {(s, "o_totalprice"): "decimal(15,2)" for s in ("F", "O", "P")}
    loader = Loader(spark, scratch_path(spark, "load-outcomes"), {"postgresql": reader}, parallel=5, overrides=kinds)
    done = {o.job.obj_name: o for o in loader.full_load(folder)}
    loaded = [loader.table(o.job).read() for o in done.values() if o.inserted]
    price = reduce(DataFrame.unionAll, [t.select("o_orderstatus", "o_totalprice") for t in loaded])
    price = price.groupBy("o_orderstatus").agg(F.sum("o_totalprice").cast("string").alias("price"))
    logged = loader.control().select(
        F.col("SOURCE_OBJECT_NAME").alias("object"), F.col("STATUS").alias("status"), F.col("ROWS_INSERTED").cast("long").alias("inserted"),
        F.col("MAX_TIMESTAMP").cast("date").alias("mark"), (F.col("ERROR_MESSAGE") != "-").alias("has_error"))
    return logged.join(price, logged.object == price.o_orderstatus, "left").drop("o_orderstatus")


def catalog_synthetic(spark, sf_dir):
    """The catalog of the orders' values with the load-time column, which is appended once."""
    found = cat.file_catalog(as_text(table(spark, sf_dir, "orders"))).select("column_name", "data_type")
    return cat.with_synthetic(cat.with_synthetic(found))


REQUESTS = [("POSTGRESQL", "int8"), ("POSTGRESQL", "numeric"), ("POSTGRESQL", "timestamptz"), ("POSTGRESQL", "jsonb"), ("SQLSERVER", "datetime2"),
            ("SQLSERVER", "bit"), ("SQLSERVER", "text"), ("SQLSERVER", "hierarchyid"), ("SAP_ODATA", "Edm.Decimal"), ("SAP_ODATA", "Edm.Time"),
            ("EXCEL", "int64"), ("EXCEL", "complex128")]


def type_map_systems(spark, sf_dir):
    """Every part asks for the type of one of the systems' columns."""
    n = len(REQUESTS)
    system, kind = (F.element_at(F.array(*[F.lit(r[k]) for r in REQUESTS]), (F.col("p_partkey") % n + 1).cast("int")) for k in (0, 1))
    asked = table(spark, sf_dir, "part").select("p_partkey", system.alias("system"), kind.alias("source_type"))
    return lookup(asked, TypeMap(), F.col("system"), F.col("source_type"))


QUERIES = {
    "doc_rejects": doc_rejects,
    "odata_pages_flatten": odata_pages_flatten,
    "stage_roundtrip": stage_roundtrip,
    "control_append": control_append,
    "job_table": job_table,
    "load_outcomes": load_outcomes,
    "catalog_synthetic": catalog_synthetic,
    "type_map_systems": type_map_systems,
}

ORACLES = {
    "doc_rejects": "SELECT event_type, count(*) FILTER (WHERE user_id % 7 = 0) AS rejected, count(*) AS lines FROM events GROUP BY event_type",
    "odata_pages_flatten": "SELECT event_id AS id, value AS amount, date_trunc('millisecond', ts) AS at FROM events",
    "stage_roundtrip": "SELECT * FROM orders",
    "control_append": """SELECT row_number() OVER (ORDER BY o_orderpriority) AS run_id, upper(o_orderpriority) AS target_table, 'SUCCESS' AS status,
        count(*) AS rows_inserted, 90.0::DOUBLE AS seconds FROM orders GROUP BY o_orderpriority""",
    "job_table": """SELECT p_type AS object, 'T_' || p_type AS target, 'p_partkey,p_brand' AS keys, count(*) % 2 = 0 AS is_file, count(*) % 3 = 0 AS is_master,
        min(p_size) % 2 = 0 AS deletes, NULL::VARCHAR AS client FROM part GROUP BY p_type""",
    "load_outcomes": """SELECT o_orderstatus AS object, 'SUCCESS' AS status, count(*) AS inserted, max(o_orderdate)::DATE AS mark, false AS has_error,
          sum(o_totalprice::DECIMAL(15,2))::VARCHAR AS price FROM orders GROUP BY o_orderstatus
        UNION ALL SELECT 'none', 'SUCCESS', 0, NULL, false, NULL UNION ALL SELECT 'broken', 'FAILED', 0, NULL, true, NULL""",
    "catalog_synthetic": """SELECT * FROM (VALUES ('o_orderkey', 'int64'), ('o_custkey', 'int64'), ('o_orderstatus', 'object'),
        ('o_totalprice', 'float64'), ('o_orderdate', 'datetime64[ns]'), ('o_orderpriority', 'object'),
        ('inserted_timestamp', 'Edm.DateTime')) t(column_name, data_type) WHERE (SELECT count(*) FROM orders) > 0""",
    "type_map_systems": """WITH known(i, system, source_type, warehouse_type, spark_type, matched) AS (VALUES
          (0, 'POSTGRESQL', 'int8', 'number', 'bigint', true), (1, 'POSTGRESQL', 'numeric', 'decimal', 'decimal(38,10)', true),
          (2, 'POSTGRESQL', 'timestamptz', 'timestamp_ntz', 'timestamp_ntz', true), (3, 'POSTGRESQL', 'jsonb', 'object', 'variant', true),
          (4, 'SQLSERVER', 'datetime2', 'timestamp_ntz', 'timestamp_ntz', true), (5, 'SQLSERVER', 'bit', 'boolean', 'boolean', true),
          (6, 'SQLSERVER', 'text', 'object', 'string', true), (7, 'SQLSERVER', 'hierarchyid', 'varchar', 'string', false),
          (8, 'SAP_ODATA', 'Edm.Decimal', 'float', 'double', true), (9, 'SAP_ODATA', 'Edm.Time', 'timestamp_tz', 'timestamp', true),
          (10, 'EXCEL', 'int64', 'varchar', 'bigint', true), (11, 'EXCEL', 'complex128', 'varchar', 'string', false))
        SELECT p_partkey, system, source_type, warehouse_type, spark_type, matched FROM part JOIN known ON p_partkey % 12 = i""",
}
