"""Readers and writers."""

import datetime as dt
import json
import os
import re
import urllib.parse

import pytest
from pyspark.sql import functions as F, types as T

from tidemark.functions import times
from tidemark.functions.typemap import TypeMap
from tidemark.operators import audit, chunk, merge as m
from tidemark.sinks import storage, tables
from tidemark.sources import catalog, documents, files, jdbc, odata

# -- relational ------------------------------------------------------------------------------------------


def test_connection_options_come_from_conf_and_environment(spark, monkeypatch):
    spark.conf.set("spark.tidemark.postgresql.host", "h")
    monkeypatch.setenv("TIDEMARK_POSTGRESQL_PORT", "1")
    monkeypatch.setenv("TIDEMARK_POSTGRESQL_USER", "u")
    o = jdbc.options(spark, "postgresql", "db")
    spark.conf.unset("spark.tidemark.postgresql.host")
    assert o["url"] == "jdbc:postgresql://h:1/db" and o["user"] == "u" and o["driver"] == "org.postgresql.Driver"
    assert jdbc.options(spark, "SQLSERVER", "db", "h", "2")["url"] == "jdbc:sqlserver://h:2;databaseName=db"


def test_split_scan_options():
    o = jdbc.table_options({"url": "x"}, "(SELECT 1) subquery", jdbc.Split("id", "0", "100", 4))
    assert (o["partitionColumn"], o["lowerBound"], o["upperBound"], o["numPartitions"]) == ("id", "0", "100", "4")
    assert "partitionColumn" not in jdbc.table_options({"url": "x"}, "t")
    assert jdbc.table_options({"url": "x"}, "t")["preferTimestampNTZ"] == "true"


def test_catalog_query_quotes_its_names():
    assert jdbc.catalog_query("t'x", "s").endswith("table_name = 't''x' AND table_schema = 's'")
    assert jdbc.catalog_query("t", "s", "a, b").endswith("column_name IN ('a', 'b')")


# -- catalogs --------------------------------------------------------------------------------------------

def test_file_catalog_follows_spreadsheet_rules(spark):
    df = spark.createDataFrame(
        [("1", "1", "1.5", "true", "2024-01-01", None, "x"), ("-2", None, "2e3", "False", "2024-01-01 10:00:00", None, "2")],
        "whole string, gaps string, num string, flag string, moment string, none string, text string")
    got = {r.column_name: r.data_type for r in catalog.file_catalog(df).collect()}
    assert got == {"whole": "int64", "gaps": "float64", "num": "float64", "flag": "bool", "moment": "datetime64[ns]",
                   "none": "float64", "text": "object"}


def test_typed_catalog_and_target_columns(spark):
    df = m.with_stamps(spark.createDataFrame([], "a int, `b.c` string, d date"))
    assert [tuple(r) for r in catalog.typed_catalog(df, "a, b.c").collect()] == [("a", "int", 1), ("b.c", "string", 2)]
    assert catalog.typed_catalog(df).count() == 5
    assert catalog.target_columns(df) == ["a", "b.c", "d"]


EDMX = """<?xml version="1.0" encoding="utf-8"?>
<edmx:Edmx Version="1.0" xmlns:edmx="http://schemas.microsoft.com/ado/2007/06/edmx"><edmx:DataServices>
<Schema xmlns="http://schemas.microsoft.com/ado/2008/09/edm">
<EntityType Name="Address"><Key><PropertyRef Name="Client"/></Key><Property Name="Client" Type="Edm.String" MaxLength="3"/>
<Property Name="Date" Type="Edm.DateTime"/></EntityType>
<EntityType Name="Other"><Property Name="X" Type="Edm.Int32"/></EntityType>
</Schema></edmx:DataServices></edmx:Edmx>"""


def test_edmx_files(spark, tmp_path):
    (tmp_path / "m.xml").write_text(EDMX)
    found = catalog.of_entity_set(catalog.read_edmx(spark, str(tmp_path)), "addressSet")
    assert sorted((r.column_name, r.data_type) for r in found.collect()) == [("Client", "Edm.String"), ("Date", "Edm.DateTime")]
    more = catalog.with_synthetic(found)
    assert more.count() == 3 and catalog.with_synthetic(more).count() == 3


def test_metadata_document(spark):
    text = EDMX.replace('<Property Name="Date" Type="Edm.DateTime"/>', '<Property Name="Amt" Type="Edm.Decimal" Precision="13" Scale="3"/>')
    found = catalog.of_entity_set(catalog.metadata_columns(spark, text), "AddressSet")
    assert sorted((r.column_name, r.data_type) for r in found.collect()) == [("Amt", "Edm.Decimal(13,3)"), ("Client", "Edm.String")]


# -- files -----------------------------------------------------------------------------------------------

def test_inventory(spark, tmp_path):
    for name, at in (("source/Sales_Zone.xlsx", 100), ("archive/Sales_Zone.xlsx", 50), ("source/New.xlsx", 70), ("source/note.txt", 1)):
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_text("x")
        os.utime(path, (at, at))
    found = files.inventory(spark, str(tmp_path))
    assert found.count() == 3
    prefixes = [f"file:{tmp_path}/source/", f"file:{tmp_path}/archive/"]
    latest = {r.name: r.path.split("/")[-2] for r in files.newest(found, prefixes).collect()}
    assert latest == {"Sales_Zone.xlsx": "source", "New.xlsx": "source"}
    source, archive = [files.newest(found.where(F.col("path").contains(f"/{f}/")), prefixes) for f in ("source", "archive")]
    assert {r.name for r in files.newer_than_archive(source, archive).collect()} == {"Sales_Zone.xlsx", "New.xlsx"}
    assert {r.name for r in files.newer_than_archive(source, source).collect()} == set()
    assert files.file_of(found, "ZONE").first()["path"].endswith("archive/Sales_Zone.xlsx")
    assert files.file_of(found, "ZONE").first()["matching"] == 2
    assert tuple(files.file_of(found, "nothing").first()) == (None, 0)


# -- documents -------------------------------------------------------------------------------------------

def test_array_files_and_lines(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "1.json").write_text(json.dumps([{"_id": i, "v": {"x": i}} for i in range(3)], indent=2))
    (tmp_path / "a" / "2.json").write_text('{"_id": 9}')
    ids = sorted(r[0] for r in documents.read_arrays(spark, str(tmp_path / "a")).select(
        F.variant_get("raw_data", "$._id", "int")).collect())
    assert ids == [0, 1, 2, 9]
    (tmp_path / "a" / "3.json").write_text('[{"_id": 1}, {"_id"')
    with pytest.raises(Exception, match="no JSON value could be read from .*3.json"):
        documents.read_arrays(spark, str(tmp_path / "a")).collect()
    (tmp_path / "l.json").write_text('{"_id":1}\n\nnot json\n{"_id":\n')
    with pytest.raises(Exception, match="line without a JSON document"):
        documents.read_lines(spark, str(tmp_path / "l.json")).collect()
    kept = documents.read_lines(spark, str(tmp_path / "l.json"), str(tmp_path / "bad"))
    assert [r[0] for r in kept.select(F.variant_get("raw_data", "$._id", "int")).collect()] == [1]
    assert sorted(r[0] for r in spark.read.text(str(tmp_path / "bad")).collect()) == ["not json", '{"_id":']


def test_collection_options():
    o = documents.collection_options("uri", "db", "members", dt.datetime(2024, 1, 2, 3, 4, 5, 678000))
    at = {"$gt": {"$date": "2024-01-02T03:04:05.678Z"}}
    assert json.loads(o["aggregation.pipeline"]) == [{"$match": {"$or": [{"createdAt": at}, {"updatedAt": at}]}}]
    assert "aggregation.pipeline" not in documents.collection_options("uri", "db", "members")


def test_chunked_json(spark, tmp_path):
    df = spark.range(10, numPartitions=1).withColumn("gap", F.when(F.col("id") > 4, F.col("id")))
    tables.write_chunks(df, f"{tmp_path}/out", 4)
    parts = [p for p in (tmp_path / "out").iterdir() if p.suffix == ".json"]
    assert sorted(len(p.read_text().splitlines()) for p in parts) == [2, 4, 4]
    assert not any("NaN" in p.read_text() or '"gap":null' in p.read_text() for p in parts)


@pytest.mark.parametrize("buckets", [1, 7])
def test_chunk_numbers(spark, buckets):
    df = spark.range(0, 3000, 3).withColumn("x", F.lit("a"))
    got = {r.id: r.chunk for r in chunk.assign_chunks(df, "id", 100, buckets).collect()}
    assert got == {i * 3: i // 100 + 1 for i in range(1000)}
    assert chunk.assign_chunks(df.limit(0), "id", 100, buckets).count() == 0


def test_chunks_of_a_hot_id(spark):
    """One id holds a third of the rows: chunks are still full and in id order, and no task holds them all."""
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 1000).otherwise(F.col("id")).cast("long").alias("id"))
    got = chunk.assign_chunks(df, "id", 100, 8)
    sizes = {r["chunk"]: r["count"] for r in got.groupBy("chunk").count().collect()}
    assert sizes == {i: 100 for i in range(1, 31)}
    spans = got.groupBy("chunk").agg(F.min("id").alias("low"), F.max("id").alias("high")).orderBy("chunk").collect()
    assert all(a.high <= b.low for a, b in zip(spans, spans[1:]))


def test_bounds_query():
    assert jdbc.bounds_query("s.t", "id") == "SELECT MIN(id) AS low, MAX(id) AS high FROM s.t"


# -- OData -----------------------------------------------------------------------------------------------

def fake_service(cap=10**9, links=False, total=23):
    """Serves entities from the query text, without a network: at most ``cap`` per page, with links to the next page or without,
    in key order only if that is asked for."""
    class FakeService(odata.ODataSource):
        @classmethod
        def name(cls):
            return "fake_odata"

        @staticmethod
        def fetch(url, options):
            skip, top = int(re.search(r"\$skip=(\d+)", url)[1]), int(re.search(r"\$top=(\d+)", url)[1])
            rows = [{"Id": i, "Name": f"n{i}", "Nest": {"a": [i]}, "Gone": None} for i in range(total)]
            if "$orderby=Id" not in url:
                rows = rows[skip % 7:] + rows[:skip % 7]
            split = re.search(r"mod%20(\d)%20eq%20(\d)", url)
            if split:
                rows = [r for r in rows if r["Id"] % int(split[1]) == int(split[2])]
            page = rows[skip:skip + min(top, cap)]
            reply = {"results": page}
            if links and skip + len(page) < len(rows):
                reply["__next"] = re.sub(r"skip=\d+", f"skip={skip + len(page)}", url)
            return json.dumps({"d": reply}).encode()

    return FakeService


@pytest.mark.parametrize("cap", [1, 100, 499, 500])
@pytest.mark.parametrize("links", [True, False])
def test_odata_page_caps(cap, links):
    """However a service caps its pages, every entity arrives once."""
    names = T.StructType([T.StructField("Id", T.StringType())])
    total = 60 if cap == 1 else 1000
    reader = odata.ODataReader(names, {"url": "http://x/", "entity": "S", "order": "Id"}, fake_service(cap, links, total).fetch)
    assert [int(r[0]) for p in reader.partitions() for r in reader.read(p)] == list(range(total))


def ranged_service(rows, cap=10**9, v4=False):
    """Answers counts, quantile probes and key ranges; orders text without regard to case, nulls first, as some databases do."""
    def place(v):
        return (v is not None, v.lower() if isinstance(v, str) else v or 0)

    def holds(row, text):
        for term in text.replace("(", "").replace(")", "").split(" and "):
            name, op, value = term.split(" ", 2)
            value = None if value == "null" else value[1:-1].replace("''", "'") if value[0] == "'" else int(value.rstrip("L"))
            own = row[name]
            if not {"eq": own == value, "lt": own is not None and place(own) < place(value), "ge": own is not None and place(own) >= place(value)}[op]:
                return False
        return True

    def fetch(url, options):
        url = urllib.parse.unquote(url)
        asked = re.search(r"\$filter=([^&]*)", url)
        found = [r for r in rows if holds(r, asked[1])] if asked else list(rows)
        if "/$count" in url:
            return f"\ufeff{len(found)}".encode()
        found.sort(key=lambda r: place(r["K"]))
        skip, top = int(re.search(r"skip=(\d+)", url)[1]), int(re.search(r"top=(\d+)", url)[1])
        page = found[skip:skip + min(top, cap)]
        return json.dumps({"value": page} if v4 else {"d": {"results": page}}).encode()

    return fetch


@pytest.mark.parametrize("cap", [7, 10**9])
@pytest.mark.parametrize("kind, make", [
    ("Edm.Int64", lambda i: i), ("Edm.Int64", lambda i: i % 3), ("Edm.String", lambda i: "aBc'"[i % 4] * (i % 9 + 1)),
    ("Edm.String", lambda i: None if i % 3 == 0 else f"k{i}"), ("Edm.String", lambda i: None), ("Edm.Int32", lambda i: 5)])
def test_entity_ranges_lose_and_double_nothing(cap, kind, make):
    rows = [{"Id": i, "K": make(i)} for i in range(300)]
    schema = T.StructType([T.StructField("Id", T.StringType())])
    options = {"url": "http://x", "entity": "S", "order": "K", "page": "20", "parallel": "8", "range_key": "K", "range_type": kind}
    for v4 in (False, True):
        reader = odata.ODataReader(schema, options, ranged_service(rows, cap, v4))
        parts = reader.partitions()
        got = [[int(r[0]) for r in reader.read(p)] for p in parts]
        assert sorted(i for part in got for i in part) == list(range(300))
        if make(1) == 1 and make(5) == 5:
            assert len(parts) == 9 and max(map(len, got)) < 50 and got[-1] == []


def test_small_sets_and_silent_services_are_one_part():
    rows = [{"Id": i, "K": i} for i in range(19)]
    options = {"url": "http://x", "entity": "S", "page": "20", "parallel": "8", "range_key": "K", "range_type": "Edm.Int32"}
    schema = T.StructType([T.StructField("Id", T.StringType())])
    assert [p.value for p in odata.ODataReader(schema, options, ranged_service(rows)).partitions()] == [None]
    assert [p.value for p in odata.ODataReader(schema, options, lambda url, o: b"<html>").partitions()] == [None]
    assert [p.value for p in odata.ODataReader(schema, {**options, "range_type": "Edm.DateTime"}, None).partitions()] == [None]
    with_filter = odata.ODataReader(schema, {**options, "page": "2", "filter": "K ge 9"}, ranged_service(rows))
    assert sorted(int(r[0]) for p in with_filter.partitions() for r in with_filter.read(p)) == list(range(9, 19))


@pytest.mark.parametrize("page, splits", [(5, ["Id mod 3 eq 0", "Id mod 3 eq 1", "Id mod 3 eq 2"]), (23, []), (1, [])])
def test_odata_pages(spark, page, splits):
    df = odata.read_entities(spark, ["Id", "Name", "Nest", "Gone"], fake_service(), url="http://x/", entity="S", order="Id",
                             page=page, splits=json.dumps(splits))
    assert df.rdd.getNumPartitions() == max(1, len(splits))
    rows = sorted(df.collect(), key=lambda r: int(r.Id))
    assert [r.Id for r in rows] == [str(i) for i in range(23)]
    assert rows[3].Nest == '{"a": [3]}' and rows[3].Gone is None


def test_odata_types(spark):
    df = spark.createDataFrame([("/Date(1609459200123)/", "PT12H30M05S", "1.25", "7", "x"), ("2021-01-01T00:00:00", None, None, "y", None)],
                               "at string, t string, amt string, n string, s string")
    types = [("at", "Edm.DateTime"), ("t", "Edm.Time"), ("amt", "Edm.Decimal(5,2)"), ("n", "Edm.Int32"), ("s", "Edm.String"), ("gone", "Edm.Byte")]
    out = odata.typed_entities(df, types, TypeMap())
    assert out.schema.simpleString() == "struct<at:timestamp_ntz,t:timestamp,amt:decimal(5,2),n:bigint,s:string>"
    rows = out.select("at", F.date_format("t", "HH:mm:ss").alias("t"), F.col("amt").cast("string"), "n", "s").collect()
    assert tuple(rows[0]) == (dt.datetime(2021, 1, 1, 0, 0, 0, 123000), "12:30:05", "1.25", 7, "x")
    assert tuple(rows[1]) == (dt.datetime(2021, 1, 1), None, None, None, None)


def test_odata_url():
    reader = odata.ODataReader(None, {"url": "http://x/", "entity": "S", "client": "?c=1", "filter": "'DATE' eq '1'"}, None)
    assert reader.url(500) == "http://x/S?c=1&$skip=500&$top=500&$format=json&$filter=%27DATE%27%20eq%20%271%27"


def test_landed_pages(spark, tmp_path):
    (tmp_path / "p1.json").write_text(json.dumps({"d": {"results": [{"a": 1, "n": {"x": 1}}, {"a": 2, "l": [1, 2]}]}}))
    got = sorted((r.a, r.n, r.l) for r in odata.read_pages(spark, str(tmp_path)).collect())
    assert got == [(1, '{"x":1}', None), (2, None, "[1,2]")]


# -- sinks -----------------------------------------------------------------------------------------------

def test_versions(spark, tmp_path):
    t = tables.VersionedTable(spark, f"{tmp_path}/t")
    assert t.current() is None and t.read() is None
    assert t.create(tables.target_struct(spark.createDataFrame([], "a int").schema)) == 1
    assert t.create(None) == 1
    assert t.write(m.with_stamps(spark.createDataFrame([(1,)], "a int"), "2024-01-01 00:00:00")) == 2
    assert t.read().count() == 1 and t.read(1).count() == 0
    # a version without its commit marker is not seen, and the next write replaces it
    os.makedirs(f"{tmp_path}/t/v=00000003")
    (tmp_path / "t" / "v=00000003" / "part-0.parquet").write_text("half written")
    assert t.current() == 2
    assert t.write(t.read()) == 3 and t.read().count() == 1
    assert t.drop_old(keep=1) == [1, 2] and t.versions() == [3]


def test_a_version_can_be_written_from_the_one_before(spark, tmp_path):
    t = tables.VersionedTable(spark, f"{tmp_path}/t")
    t.write(m.with_stamps(spark.range(5).toDF("a"), "2024-01-01 00:00:00"))
    source = spark.range(3, 8).toDF("a")
    v = t.write(m.next_version(m.merge(t.read(), source, ["a"], "2030-01-01 00:00:00")))
    assert tables.written_counts(t, v, "2030-01-01 00:00:00", 5) == {"inserted": 3, "updated": 0, "deleted": 0}
    changed = m.changed_since_stamp(t.read(), ["a"], "2030-01-01 00:00:00")
    assert sorted(tuple(r) for r in changed.collect()) == [(5, "insert"), (6, "insert"), (7, "insert")]


def test_stage_archive_and_retention(spark, tmp_path):
    folder = f"{tmp_path}/stage"
    for run, n in (("20240101T000000", 2), ("20240301T000000", 3)):
        assert tables.write_stage(spark.range(n), folder, run).endswith(f"load_ts={run}")
    assert tables.read_archive(spark, folder).groupBy("load_ts").count().count() == 2
    assert tables.read_stage(spark, folder).count() == 5 and tables.read_stage(spark, folder, "*.json", "id long").count() == 0
    assert tables.drop_expired_stages(spark, folder, "20240201") == ["load_ts=20240101T000000"]
    assert tables.read_archive(spark, folder).count() == 3
    tables.append_archive(spark.range(2), f"{tmp_path}/archive", "2024-01-01 00:00:00")
    tables.append_archive(spark.range(2), f"{tmp_path}/archive", "2024-01-02 00:00:00")
    assert spark.read.parquet(f"{tmp_path}/archive").count() == 4


def test_expired_files(spark):
    log = spark.createDataFrame([("a", dt.datetime(2024, 1, 1)), ("b", dt.datetime(2024, 1, 31))], "path string, modified timestamp_ntz")
    assert [r.path for r in tables.expired(log, "modified", times.ntz("2024-02-10 00:00:00")).collect()] == ["a"]


def test_plain_parquet_cannot_be_merged_in_place(spark, tmp_path):
    """The in-place merge needs a row-level table format; Parquet says so."""
    spark.sql(f"CREATE TABLE merge_probe (a INT, EDW_INSERTED_TIMESTAMP TIMESTAMP_NTZ, EDW_UPDATED_TIMESTAMP TIMESTAMP_NTZ) USING parquet LOCATION '{tmp_path}/p'")
    with pytest.raises(Exception, match="(?i)merge"):
        tables.merge_into(spark.range(1).toDF("a"), "merge_probe", ["a"], "2030-01-01 00:00:00")
    spark.sql("DROP TABLE merge_probe")


def test_run_seconds(spark):
    row = spark.sql("select timestamp_ntz'2024-01-01 00:00:00' a, timestamp_ntz'2024-01-01 00:01:30.25' b")
    assert row.select(audit.run_seconds(F.col("a"), F.col("b"))).first()[0] == 90.25


def test_scratch_needs_a_shared_folder(monkeypatch):
    class Session:
        class sparkContext:
            master = "spark://host:7077"

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        storage.shared_dir(Session)
    Session.sparkContext.master = "local[4]"
    assert storage.shared_dir(Session) == storage.shared_dir(Session)
    Session.conf.get = staticmethod(lambda key, default=None: "s3a://lake/tmp/")
    assert storage.scratch_path(Session, "x").startswith("s3a://lake/tmp/tidemark/x-")


def test_slices_cover_every_row_once():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute("CREATE TABLE t AS SELECT CASE WHEN i % 3 = 0 THEN 7 WHEN i % 11 = 0 THEN NULL ELSE i END AS k FROM range(1000) r(i)")
    highs = [r[1] for r in con.execute(jdbc.slices_query("t", "k", 8)).fetchall()]
    parts = [con.execute(f"SELECT count(*) FROM t WHERE {p}").fetchone()[0] for p in jdbc.slices("k", highs)]
    assert sum(parts) == 1000 and sorted(parts)[-2] < 200  # only the hot value's slice stands out
    assert jdbc.slices("day", [dt.date(2024, 1, 1)]) == ["day <= '2024-01-01'", "day > '2024-01-01'", "day IS NULL"]
    assert jdbc.slices("k", []) == ["k IS NULL"]
    at = dt.datetime(2024, 1, 1, 0, 0, 0, 500)
    assert jdbc.slices("at", [at], "sqlserver")[0] == "at <= CAST('2024-01-01 00:00:00.000500' AS DATETIME2)"
    assert jdbc.slices("k", ["it's"])[0] == "k <= 'it''s'"


def test_slices_follow_the_order_of_the_database():
    """Under an order without regard to case, bounds sorted in Python's order would overlap."""
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute('CREATE TABLE t ("Key" VARCHAR COLLATE NOCASE, day TIMESTAMP)')
    con.execute("INSERT INTO t SELECT chr((65 + i % 26 + 32 * (i % 2))::INT) || (i % 50), TIMESTAMP '2024-01-01' + to_days(i::INT) FROM range(2000) r(i)")
    where = jdbc.changed_condition(dt.datetime(2024, 6, 1), "day", None, "postgresql")
    found = con.execute(jdbc.slices_query("t", jdbc.quoted("Key"), 7, where)).fetchall()
    parts = jdbc.slices(jdbc.quoted("Key"), [h for _, h in sorted(found)])
    assert sum(con.execute(f"SELECT count(*) FROM t WHERE {p}").fetchone()[0] for p in parts) == 2000 and len(parts) > 4
    assert con.execute(jdbc.count_query("t", where)).fetchone()[0] < 2000


def test_few_rows_are_not_sliced(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(jdbc, "read_query", lambda s, o, query, split=None: asked.append(query) or s.createDataFrame([(150_000,)], "n long"))
    monkeypatch.setattr(jdbc, "read_table", lambda s, o, table, cols=None, split=None: "one query")
    assert jdbc.read_slices(spark, {"url": "x"}, "s.t", "id", 64) == "one query"
    assert asked == ["SELECT COUNT(*) AS n FROM s.t"]


def test_entity_pages_are_bounded(spark):
    """A user with most of the events gets many pages; users without an id keep theirs."""
    from tidemark.workload.landing import entity_pages

    user = F.when(F.col("id") % 3 > 0, 1).when(F.col("id") % 9 == 0, F.lit(None)).otherwise(F.col("id"))
    events = spark.range(20_000).select((F.col("id") % 10_000).alias("event_id"), user.cast("long").alias("user_id"), F.lit(0.5).alias("value"),
                                        F.timestamp_seconds(F.col("id")).alias("ts"))
    pages = [json.loads(r.page)["d"]["results"] for r in entity_pages(events, size=100).collect()]
    assert max(map(len, pages)) <= 200
    assert sorted(int(x["Id"]) for p in pages for x in p) == sorted(i % 10_000 for i in range(20_000))
