"""Cleaning, typing, catalogs, documents, OData, files, chunks and the control log."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from tidemark.functions import times
from tidemark.functions.documents import canonical, field, nested_to_text, numbers_to_text
from tidemark.functions.names import clean_headers, column
from tidemark.functions.rows import plain
from tidemark.functions.text import strip_strings
from tidemark.functions.typemap import TypeMap, cast_to, failed_casts, lookup
from tidemark.operators import merge as m
from tidemark.operators.audit import run_seconds, run_summary
from tidemark.operators.chunk import assign_chunks
from tidemark.operators.dedup import latest_document_per_key
from tidemark.operators.evolve import schema_drift
from tidemark.operators.increment import changed_since
from tidemark.sinks.storage import scratch_path
from tidemark.sinks.tables import expired
from tidemark.sources import catalog as cat, files
from tidemark.sources.documents import RAW, elements, parse_documents, picked, read_large_arrays, union_documents
from tidemark.sources.odata import filter_column
from tidemark.sources.workbooks import sheet_rows
from tidemark.workload import fixtures as fx
from tidemark.workload.books import part_book
from tidemark.workload.fixtures import CONTROL, DOCUMENTS, OLD_STAMP, STAMP, canonical_sql, table

CHUNK = 128
MICROS = "'%Y-%m-%d %H:%M:%S.%f'"


def as_text(df):
    """A table as a landed sheet: every cell is text."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


# -- cleaning ----------------------------------------------------------------------------------------------

def clean_strings(spark, sf_dir):
    pads = F.array(F.lit(""), F.lit("  "), F.lit("\t "), F.lit(" \n"))
    pad = F.element_at(pads, (F.col("p_partkey") % 4 + 1).cast("int"))
    dirty = table(spark, sf_dir, "part").select(
        "p_partkey", F.concat(pad, "p_name", pad).alias("p_name"), F.concat(F.lit("\t"), "p_type").alias("p_type"), "p_size")
    return strip_strings(dirty, to_text=["p_size"])


def quoted_columns(spark, sf_dir):
    """Headers with dots, quotes, blanks and line breaks are cleaned, then read by name."""
    raw = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias(" Mat.Code\n"), F.col("p_name").alias('Item    "Name"'),
        F.col("p_retailprice").alias("Price (net)/unit"), F.col("p_brand").alias("\nBrand  #1 "))
    clean = clean_headers(raw)
    return clean.select(
        column("Mat.Code").alias("mat_code"), column('Item "Name"').alias("item_name"),
        column("Price (net)/unit").alias("price"), column("Brand  #1").alias("brand"))


def format_timestamps(spark, sf_dir):
    return times.timestamps_to_text(table(spark, sf_dir, "events").select("event_id", "ts"))


def dirty_times(spark, sf_dir):
    o = F.col("o_orderpriority")
    moment = F.col("o_orderdate") + F.make_dt_interval(secs=F.col("o_custkey"))
    text = (
        F.when(o == "1-URGENT", F.date_format(moment, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        .when(o == "2-HIGH", F.date_format(moment, "yyyy-MM-dd HH:mm:ss"))
        .when(o == "3-MEDIUM", F.lit("NaT")).when(o == "4-NOT SPECIFIED", F.lit("not a date"))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", text.alias("moment"))


DIRTY_TIMES = """dirty AS (
  SELECT o_orderkey, CASE o_orderpriority
    WHEN '1-URGENT' THEN strftime(o_orderdate + o_custkey * INTERVAL 1 SECOND, '%Y-%m-%d %H:%M:%S.%f')
    WHEN '2-HIGH' THEN strftime(o_orderdate + o_custkey * INTERVAL 1 SECOND, '%Y-%m-%d %H:%M:%S')
    WHEN '3-MEDIUM' THEN 'NaT' WHEN '4-NOT SPECIFIED' THEN 'not a date' END AS moment FROM orders)"""


def coerce_timestamps(spark, sf_dir):
    return dirty_times(spark, sf_dir).select("o_orderkey", times.coerce(F.col("moment")).alias("moment"))


def parse_mixed_timestamps(spark, sf_dir):
    c = F.col("moment")
    return dirty_times(spark, sf_dir).select(
        "o_orderkey", times.parse(c).alias("moment"), F.coalesce(times.unparsed(c), F.lit(False)).alias("bad"))


def tz_stamp(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", times.shift_zone(F.col("ts"), "Asia/Kolkata").alias("local_ts"))


def synthetic_ts(spark, sf_dir):
    return times.stamp_column(table(spark, sf_dir, "customer"), "inserted_timestamp", STAMP)


def sheet_read(spark, sf_dir):
    """A sheet's whole cleaning: headers, times as text, stripped strings, one column coerced to a time."""
    o = table(spark, sf_dir, "orders")
    raw = o.select(
        F.col("o_orderkey").alias(" Order Key\n"), F.col("o_orderdate").alias("Order Date"),
        F.concat(F.lit(" "), "o_orderpriority", F.lit("\t")).alias("Priority"),
        F.when(F.col("o_orderstatus") == "P", "pending").otherwise(F.col("o_orderdate").cast("string")).alias("Added_Date"))
    clean = files.clean_sheet(raw, text_columns=["Order Key"], coerced=["Added_Date"])
    return clean.toDF("order_key", "order_date", "priority", "added_date")


# -- types and catalogs --------------------------------------------------------------------------------------

def column_catalog(spark, sf_dir):
    return cat.file_catalog(as_text(table(spark, sf_dir, "customer")))


def type_map(spark, sf_dir):
    found = cat.file_catalog(as_text(table(spark, sf_dir, "lineitem")))
    return lookup(found, TypeMap(), F.lit("EXCEL"), F.col("data_type"))


def target_schema(spark, sf_dir):
    """Stage types that follow from the values, by position, and the two audit columns."""
    found = cat.file_catalog(as_text(table(spark, sf_dir, "orders")))
    typed = lookup(found, TypeMap(), F.lit("EXCEL"), F.col("data_type")).select(
        F.col("column_name"), F.col("spark_type").alias("column_type"), F.col("ordinal_position"))
    last = found.agg(F.max("ordinal_position").alias("n"))
    audit = last.select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("column_name"), F.lit("timestamp_ntz").alias("column_type"),
                 (F.col("n") + i).alias("ordinal_position"))
        for i, name in enumerate(m.AUDIT_COLUMNS, start=1)])).alias("a")).select("a.*")
    return typed.unionByName(audit)


def drift_query(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    old = c.drop("c_acctbal").withColumn("legacy_code", F.concat(F.lit("L"), "c_custkey"))
    return schema_drift(cat.file_catalog(as_text(c)), cat.file_catalog(as_text(m.with_stamps(old, OLD_STAMP))))


def stage_cast(spark, sf_dir):
    """Text cells cast to the target's types; pending orders hold a price that is no number."""
    o = table(spark, sf_dir, "orders")
    text = as_text(o).withColumn(
        "o_totalprice", F.when(F.col("o_orderstatus") == "P", "pending").otherwise(F.col("o_totalprice")))
    marked = text.withColumn("failed", failed_casts(text, o.schema))
    return cast_to(marked, T.StructType([*o.schema.fields, T.StructField("failed", T.IntegerType())]), strict=False)


def edmx_columns(spark, sf_dir):
    """Every part is described as an EDMX entity type, whose properties become catalog rows."""
    p = table(spark, sf_dir, "part")
    xml = F.concat(
        F.lit('<EntityType Name="Part'), "p_partkey", F.lit('"><Property Name="Brand" Type="Edm.String"/><Property Name="Size'),
        "p_size", F.lit('" Type="Edm.Int32"/></EntityType>'))
    return cat.entity_columns(p.select(xml.alias("xml")), "xml")


def entity_set_columns(spark, sf_dir):
    """Columns of one entity set, found in any case by its name without ``Set``."""
    p = table(spark, sf_dir, "part")
    xml = F.concat(
        F.lit('<EntityType Name="'), F.col("p_type"), F.lit('"><Property Name="Item'), "p_partkey",
        F.lit('" Type="Edm.String"/></EntityType>'))
    return cat.of_entity_set(cat.entity_columns(p.select(xml.alias("xml")), "xml"), "economySet")


# -- documents -----------------------------------------------------------------------------------------------

def doc_rows(spark, sf_dir):
    return parse_documents(fx.documents(spark, sf_dir), "body")


def doc_times(d):
    return times.parse(field(d, "createdAt")), times.parse(field(d, "updatedAt"))


def doc_scan(spark, sf_dir):
    """Only the asked fields are parsed; nothing else of a document is built."""
    d = picked(F.col("body"), "_id string, createdAt string, updatedAt string, wallet struct<balance: string>, props struct<k: bigint>")
    return fx.documents(spark, sf_dir).select(d.alias("d")).select(
        F.col("d._id").alias("id"), times.parse(F.col("d.createdAt")).alias("created"), times.parse(F.col("d.updatedAt")).alias("updated"),
        F.col("d.wallet.balance").alias("balance"), F.col("d.props.k").alias("k"))


def doc_array_scan(spark, sf_dir):
    """Arrays of two documents each; the outer array is stripped."""
    e = table(spark, sf_dir, "events")
    text = F.concat(F.lit("["), fx.document_text(F.col("value")), F.lit(","), fx.document_text(F.col("value") * 2), F.lit("]"))
    arrays = e.select(F.try_parse_json(text).alias("whole"))
    return elements(arrays, "whole").select(
        field(F.col(RAW), "_id").alias("id"), field(F.col(RAW), "wallet.balance", "double").alias("balance"))


def doc_array_large(spark, sf_dir):
    """All documents in one array file, with a number before them, read in blocks."""
    e = table(spark, sf_dir, "events")
    path = scratch_path(spark, "array-file")
    lines = e.select(F.concat(F.lit(", "), fx.document_text(F.col("value"))).alias("line"))
    ends = [spark.range(1).select(F.lit(x).alias("line")) for x in ("[0", "]")]
    ends[0].unionAll(lines).unionAll(ends[1]).coalesce(1).write.text(path)
    return read_large_arrays(spark, path).where(~F.schema_of_variant(F.col(RAW)).isin("BIGINT")).select(
        field(F.col(RAW), "_id").alias("id"), field(F.col(RAW), "wallet.balance", "double").alias("balance"))


def doc_incr_extract(spark, sf_dir):
    d = F.col(RAW)
    created, updated = doc_times(d)
    rows = doc_rows(spark, sf_dir).select(field(d, "_id").alias("id"), created.alias("created"), updated.alias("updated"))
    return changed_since(rows, "2024-01-20 00:00:00", "created", "updated")


def doc_states(spark, sf_dir):
    """Every document twice: as it is, and an earlier state with another balance."""
    e = table(spark, sf_dir, "events")
    states = e.withColumn("_age", F.explode(F.array(F.lit(0), F.lit(1))))
    updated = F.when(F.col("event_type") != "error", F.col("ts") + F.make_dt_interval(F.lit(1) - F.col("_age")))
    created = F.col("ts") - F.make_dt_interval(F.col("_age"))
    balance = F.when(F.col("_age") == 0, F.col("value")).otherwise(F.lit(0.5))
    return states.withColumn("ts", created).select(fx.document_text(balance, updated).alias("body"))


def latest_documents(spark, sf_dir):
    """Key and times are picked before the shuffle; only the winners are parsed whole and turned into canonical text."""
    d = picked(F.col("body"), "_id string, createdAt string, updatedAt string")
    rows = doc_states(spark, sf_dir).select(d.alias("d"), "body").select(
        F.col("d._id").alias("id"), times.parse(F.col("d.createdAt")).alias("created"), times.parse(F.col("d.updatedAt")).alias("updated"), "body")
    latest = latest_document_per_key(rows, F.col("id"), F.col("created"), F.col("updated"), F.col("body"))
    return latest.select("id", canonical(F.parse_json("body")).alias("document"))


def doc_merge(spark, sf_dir):
    """Signups were not loaded yet, purchases have another balance in the target."""
    e = table(spark, sf_dir, "events").where("event_type <> 'signup'")
    balance = F.when(F.col("event_type") == "purchase", F.col("value") + 1).otherwise(F.col("value"))
    target = e.select(F.col("event_id").cast("string").alias("id"), fx.document_text(balance, sort_keys=True).alias("document"))
    out = m.merge(m.with_stamps(target, OLD_STAMP), latest_documents(spark, sf_dir), ["id"], STAMP, null_keys="rare")
    return out.select("id", F.col(m.ACTION).alias("action"))


def nested_cast(spark, sf_dir):
    nested = table(spark, sf_dir, "events").select(
        "event_id", F.struct(F.col("value").alias("balance"), F.col("user_id").alias("owner")).alias("wallet"),
        F.struct(F.struct(F.col("user_id").alias("points")).alias("GO")).alias("rewards"))
    done = nested_to_text(nested, ["wallet.balance", "rewards.GO.points", "rewards.GO.absent", "nothing.here"])
    return done.select("event_id", F.col("wallet.balance").alias("balance"), F.col("wallet.owner").alias("owner"),
                       F.col("rewards.GO.points").alias("points"))


def nested_cast_variant(spark, sf_dir):
    """Numbers inside documents, some of them below arrays, as text; their neighbours stay numbers."""
    e = table(spark, sf_dir, "events")
    go = F.struct(F.col("user_id").alias("points"), F.col("event_id").alias("rank"))
    rewards = F.struct(F.array(go, F.struct(F.lit(7).alias("points"), F.lit(None).cast("long").alias("rank"))).alias("GO"))
    document = F.parse_json(F.to_json(F.struct("event_id", "event_type", rewards.alias("rewards"))))
    done = numbers_to_text(document, ["rewards.GO.points", "event_type", "rewards.GO.absent", "nothing.here"])
    return e.select("event_id", canonical(done).alias("document"))


def union_docs(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return union_documents(
        e.where("event_type = 'purchase'").select("event_id", "value"),
        e.where("event_type <> 'purchase'").select("props", "event_id"))


def sheet_workbook(spark, sf_dir):
    """Parts as workbooks, one per brand, read back from their second sheet."""
    books = table(spark, sf_dir, "part").groupBy("p_brand").applyInArrow(part_book, "path string, content binary")
    rows = sheet_rows(books, "Parts")
    return rows.select("key", "name", "kind", "size", "listed", "large", F.col("price").cast("double").alias("price"))


# -- OData -----------------------------------------------------------------------------------------------------

def odata_flatten(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.struct("user_id", F.col("event_type").alias("kind")).alias("owner"),
        F.array("event_id", "user_id").alias("ids"))
    return plain(e)


_SERVICE = "http://service/{}ORDERS/"


def odata_filter_cases(spark, sf_dir):
    """All four filter rules, one per kind of event, with each event's day as the mark."""
    kind = F.col("event_type")
    given = F.when(kind == "purchase", "'AREA' eq '15' and 'DATE' eq ").when(kind == "view", "'AREA' eq '15'")
    service = F.when(kind == "signup", _SERVICE.format("DELTA_")).otherwise(_SERVICE.format(""))
    mark = F.date_format(F.col("ts") - F.expr("INTERVAL 2 DAYS"), "yyyyMMdd")
    return table(spark, sf_dir, "events").select("event_id", filter_column(given, service, mark).alias("filter_text"))


# -- files -------------------------------------------------------------------------------------------------------

def file_log(spark, sf_dir):
    """Events as a listing of workbooks in a source and an archive folder."""
    folder = F.when(F.col("value") < 20, "source/").otherwise("archive/")
    return table(spark, sf_dir, "events").select(
        F.concat(folder, F.initcap("event_type"), F.lit("_"), "user_id", F.lit(".xlsx")).alias("path"),
        F.col("ts").alias("modified"), F.col("user_id").alias("length"))


FILE_LOG = """files AS (
  SELECT CASE WHEN value < 20 THEN 'source/' ELSE 'archive/' END
      || upper(event_type[1]) || event_type[2:] || '_' || CAST(user_id AS VARCHAR) || '.xlsx' AS path,
    upper(event_type[1]) || event_type[2:] || '_' || CAST(user_id AS VARCHAR) || '.xlsx' AS name, ts AS modified
  FROM events)"""

FOLDERS = ("source/", "archive/")


def file_inventory(spark, sf_dir):
    return files.newest(file_log(spark, sf_dir), FOLDERS)


def file_match(spark, sf_dir):
    return files.file_of(file_log(spark, sf_dir), "PURCHASE_1").select("path")


def stale_files(spark, sf_dir):
    log = file_log(spark, sf_dir)
    source, archive = [files.newest(log.where(F.col("path").startswith(f)), FOLDERS) for f in FOLDERS]
    return files.newer_than_archive(source, archive).select("name", "modified")


def retention_candidates(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "ts")
    return expired(e, "ts", times.ntz("2024-02-15 00:00:00")).select("event_id")


def chunk_assign(spark, sf_dir):
    return assign_chunks(table(spark, sf_dir, "documents"), "doc_id", CHUNK).select("doc_id", "chunk")


# -- control log ---------------------------------------------------------------------------------------------------

def audit_rollup(spark, sf_dir):
    return run_summary(fx.control(spark, sf_dir))


def run_durations(spark, sf_dir):
    return fx.control(spark, sf_dir).select(
        F.col("RUN_ID").alias("run_id"), run_seconds(F.col("RUN_START"), F.col("RUN_END")).alias("seconds"))


QUERIES = {
    "clean_strings": clean_strings,
    "quoted_columns": quoted_columns,
    "format_timestamps": format_timestamps,
    "coerce_timestamps": coerce_timestamps,
    "parse_mixed_timestamps": parse_mixed_timestamps,
    "tz_stamp": tz_stamp,
    "synthetic_ts": synthetic_ts,
    "sheet_read": sheet_read,
    "column_catalog": column_catalog,
    "type_map": type_map,
    "target_schema": target_schema,
    "schema_drift": drift_query,
    "stage_cast": stage_cast,
    "edmx_columns": edmx_columns,
    "entity_set_columns": entity_set_columns,
    "doc_scan": doc_scan,
    "doc_array_scan": doc_array_scan,
    "doc_array_large": doc_array_large,
    "doc_incr_extract": doc_incr_extract,
    "doc_dedup": latest_documents,
    "doc_merge": doc_merge,
    "nested_cast": nested_cast,
    "nested_cast_variant": nested_cast_variant,
    "sheet_workbook": sheet_workbook,
    "union_documents": union_docs,
    "odata_flatten": odata_flatten,
    "odata_filter_cases": odata_filter_cases,
    "file_inventory": file_inventory,
    "file_match": file_match,
    "stale_files": stale_files,
    "retention_candidates": retention_candidates,
    "chunk_assign": chunk_assign,
    "audit_rollup": audit_rollup,
    "run_durations": run_durations,
}


# -- SQL ---------------------------------------------------------------------------------------------------------

COLUMNS = {
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
                 "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"],
}


def catalog_sql(source: str) -> str:
    """Inferred catalog of a table whose cells are read as text."""
    moment = "^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9:.]+$"
    number = "^-?[0-9]+([.][0-9]+)?([eE][+-]?[0-9]+)?$"

    def kind(c):
        t = f"CAST({c} AS VARCHAR)"

        def all_match(pattern):
            return f"count(*) FILTER (WHERE regexp_matches({t}, '{pattern}')) = count({c})"

        return (f"CASE WHEN count({c}) = 0 THEN 'float64' WHEN {all_match('^-?[0-9]+$')} AND count({c}) = count(*) THEN 'int64' "
                f"WHEN {all_match(number)} THEN 'float64' WHEN {all_match(moment)} THEN 'datetime64[ns]' ELSE 'object' END")

    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {kind(c)} AS data_type, CAST({i} AS INTEGER) AS ordinal_position FROM {source}"
        for i, c in enumerate(COLUMNS[source], start=1))


def map_sql() -> str:
    return """map(source_type, warehouse_type, spark_type) AS (VALUES ('float64', 'string', 'double'), ('object', 'varchar', 'string'),
        ('datetime64[ns]', 'timestamp_ntz', 'timestamp_ntz'), ('bool', 'boolean', 'boolean'), ('int64', 'varchar', 'bigint'),
        ('integer', 'varchar', 'string'))"""


_DOC_STATES = f"""{DOCUMENTS}, states AS (
  SELECT id, created, updated, k, CAST(value AS VARCHAR) AS balance FROM docs
  UNION ALL
  SELECT id, created - INTERVAL 1 DAY, CASE WHEN event_type <> 'error' THEN created END, k, '0.5' FROM docs),
latest_docs AS (
  SELECT id, {canonical_sql('balance')} AS document FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY coalesce(updated, created) DESC NULLS FIRST) AS rn FROM states)
  WHERE rn = 1)"""

ORACLES = {
    "clean_strings": r"""WITH dirty AS (SELECT p_partkey, p_size, p_type,
          CASE p_partkey % 4 WHEN 0 THEN '' WHEN 1 THEN '  ' WHEN 2 THEN chr(9) || ' ' ELSE ' ' || chr(10) END AS pad, p_name FROM part)
        SELECT p_partkey, regexp_replace(pad || p_name || pad, '^\s+|\s+$', '', 'g') AS p_name,
          regexp_replace(chr(9) || p_type, '^\s+', '') AS p_type, CAST(p_size AS VARCHAR) AS p_size FROM dirty""",
    "quoted_columns": "SELECT p_partkey AS mat_code, p_name AS item_name, p_retailprice AS price, p_brand AS brand FROM part",
    "format_timestamps": f"SELECT event_id, strftime(ts, {MICROS}) AS ts FROM events",
    "coerce_timestamps": f"WITH {DIRTY_TIMES} SELECT o_orderkey, TRY_CAST(moment AS TIMESTAMP) AS moment FROM dirty",
    "parse_mixed_timestamps": f"""WITH {DIRTY_TIMES} SELECT o_orderkey, TRY_CAST(moment AS TIMESTAMP) AS moment,
        coalesce(moment <> 'NaT' AND TRY_CAST(moment AS TIMESTAMP) IS NULL, false) AS bad FROM dirty""",
    "tz_stamp": "SELECT event_id, ts + INTERVAL 330 MINUTE AS local_ts FROM events",
    "synthetic_ts": f"SELECT *, TIMESTAMP '{STAMP}' AS inserted_timestamp FROM customer",
    "sheet_read": f"""SELECT CAST(o_orderkey AS VARCHAR) AS order_key, strftime(o_orderdate, {MICROS}) AS order_date,
        o_orderpriority AS priority, CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, {MICROS}) END AS added_date FROM orders""",
    "column_catalog": catalog_sql("customer"),
    "type_map": f"""WITH found AS ({catalog_sql('lineitem')}), {map_sql()}
        SELECT column_name, data_type, ordinal_position, coalesce(warehouse_type, 'varchar') AS warehouse_type,
          coalesce(spark_type, 'string') AS spark_type, warehouse_type IS NOT NULL AS matched
        FROM found LEFT JOIN map ON data_type = source_type""",
    "target_schema": f"""WITH found AS ({catalog_sql('orders')}), {map_sql()}
        SELECT column_name, coalesce(spark_type, 'string') AS column_type, ordinal_position FROM found LEFT JOIN map ON data_type = source_type
        UNION ALL SELECT 'EDW_INSERTED_TIMESTAMP', 'timestamp_ntz', CAST(max(ordinal_position) + 1 AS INTEGER) FROM found
        UNION ALL SELECT 'EDW_UPDATED_TIMESTAMP', 'timestamp_ntz', CAST(max(ordinal_position) + 2 AS INTEGER) FROM found""",
    "schema_drift": f"""WITH source AS ({catalog_sql('customer')}),
        target AS (SELECT column_name FROM source WHERE column_name <> 'c_acctbal' UNION ALL SELECT 'legacy_code')
        SELECT coalesce(s.column_name, t.column_name) AS column_name,
          CASE WHEN t.column_name IS NULL THEN 'added' WHEN s.column_name IS NULL THEN 'missing' ELSE 'same' END AS status
        FROM source s FULL OUTER JOIN target t ON s.column_name = t.column_name""",
    "stage_cast": """SELECT * REPLACE (CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS o_totalprice),
        CAST(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS INTEGER) AS failed FROM orders""",
    "edmx_columns": """SELECT 'Part' || CAST(p_partkey AS VARCHAR) AS entity_type, 'Brand' AS column_name, 'Edm.String' AS data_type FROM part
        UNION ALL SELECT 'Part' || CAST(p_partkey AS VARCHAR), 'Size' || CAST(p_size AS VARCHAR), 'Edm.Int32' FROM part""",
    "entity_set_columns": """SELECT p_type AS entity_type, 'Item' || CAST(p_partkey AS VARCHAR) AS column_name,
        'Edm.String' AS data_type FROM part WHERE lower(p_type) = 'economy'""",
    "doc_scan": f"WITH {DOCUMENTS} SELECT id, created, updated, CAST(value AS VARCHAR) AS balance, CAST(k AS BIGINT) AS k FROM docs",
    "doc_array_scan": f"""WITH {DOCUMENTS} SELECT id, value AS balance FROM docs UNION ALL SELECT id, value * 2 FROM docs""",
    "doc_array_large": f"WITH {DOCUMENTS} SELECT id, value AS balance FROM docs",
    "doc_incr_extract": f"""WITH {DOCUMENTS} SELECT id, created, updated FROM docs
        WHERE created > TIMESTAMP '2024-01-20 00:00:00' OR updated > TIMESTAMP '2024-01-20 00:00:00'""",
    "doc_dedup": f"WITH {_DOC_STATES} SELECT id, document FROM latest_docs",
    "doc_merge": f"""WITH {_DOC_STATES}, target AS (
          SELECT id, {canonical_sql("CAST(CASE WHEN event_type = 'purchase' THEN value + 1 ELSE value END AS VARCHAR)")} AS document
          FROM docs WHERE event_type <> 'signup')
        SELECT coalesce(s.id, t.id) AS id, CASE WHEN t.id IS NULL THEN 'insert' WHEN s.id IS NULL THEN 'keep'
          WHEN s.document <> t.document THEN 'update' ELSE 'keep' END AS action
        FROM latest_docs s FULL OUTER JOIN target t ON s.id = t.id""",
    "nested_cast_variant": """SELECT event_id, '{"event_id":' || CAST(event_id AS VARCHAR) || ',"event_type":"' || event_type
        || '","rewards":{"GO":[{"points":"' || CAST(user_id AS VARCHAR) || '","rank":' || CAST(event_id AS VARCHAR)
        || '},{"points":"7"}]}}' AS document FROM events""",
    "sheet_workbook": """SELECT CAST(p_partkey AS VARCHAR) AS key, p_name AS name, p_type AS kind,
        CASE WHEN p_size % 5 <> 0 THEN CAST(p_size AS VARCHAR) END AS size,
        strftime(TIMESTAMP '2024-01-01' + p_size * INTERVAL 1 DAY + (p_size % 24) * INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS listed,
        CASE WHEN p_size > 25 THEN 'true' ELSE 'false' END AS large, p_retailprice AS price FROM part""",
    "nested_cast": """SELECT event_id, CAST(value AS VARCHAR) AS balance, user_id AS owner, CAST(user_id AS VARCHAR) AS points FROM events""",
    "union_documents": """SELECT event_id, value, CAST(NULL AS VARCHAR) AS props FROM events WHERE event_type = 'purchase'
        UNION ALL SELECT event_id, NULL, props FROM events WHERE event_type <> 'purchase'""",
    "odata_flatten": """SELECT event_id, event_type,
        '{"user_id":' || CAST(user_id AS VARCHAR) || ',"kind":"' || event_type || '"}' AS owner,
        '[' || CAST(event_id AS VARCHAR) || ',' || CAST(user_id AS VARCHAR) || ']' AS ids FROM events""",
    "odata_filter_cases": """SELECT event_id, CASE event_type
        WHEN 'purchase' THEN '''AREA'' eq ''15'' and ''DATE'' eq ''' || strftime(ts - INTERVAL 2 DAY, '%Y%m%d') || ''''
        WHEN 'view' THEN '''AREA'' eq ''15'''
        WHEN 'signup' THEN '''DATE'' eq ''' || strftime(ts - INTERVAL 2 DAY, '%Y%m%d') || '''' END AS filter_text FROM events""",
    "file_inventory": f"""WITH {FILE_LOG} SELECT name, path, modified FROM (
        SELECT *, row_number() OVER (PARTITION BY name ORDER BY modified DESC, path DESC) AS rn FROM files) WHERE rn = 1""",
    "file_match": f"""WITH {FILE_LOG} SELECT min(path) AS path FROM files WHERE lower(path) = 'purchase_1'
        OR contains(lower(path), '/purchase_1') OR contains(lower(path), '_purchase_1')""",
    "stale_files": f"""WITH {FILE_LOG}, s AS (SELECT name, max(modified) AS modified FROM files WHERE path LIKE 'source/%' GROUP BY name),
        a AS (SELECT name, max(modified) AS archived FROM files WHERE path LIKE 'archive/%' GROUP BY name)
        SELECT s.name, s.modified FROM s LEFT JOIN a ON s.name = a.name WHERE archived IS NULL OR modified > archived""",
    "retention_candidates": "SELECT event_id FROM events WHERE ts < TIMESTAMP '2024-02-15 00:00:00' - INTERVAL 30 DAY",
    "chunk_assign": f"SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // {CHUNK} + 1 AS chunk FROM documents",
    "audit_rollup": f"""WITH {CONTROL} SELECT target_table AS table_name, count(*) AS runs,
        count(*) FILTER (WHERE status = 'FAILED') AS failures, CAST(sum(rows_inserted) AS BIGINT) AS rows_inserted,
        max_by(mx, run_id) FILTER (WHERE status = 'SUCCESS' AND mx <> TIMESTAMP '{fx.SENTINEL}') AS last_mark
        FROM control GROUP BY target_table""",
    "run_durations": f"WITH {CONTROL} SELECT run_id, CAST(date_diff('microsecond', run_start, run_end) AS DOUBLE) / 1000000 AS seconds FROM control",
}
