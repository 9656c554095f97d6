"""Whole loads over a job table."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions.typemap import TypeMap
from tidemark.operators.audit import failures, run_summary
from tidemark.plans import readers
from tidemark.plans.loader import DOCUMENT, Loader
from tidemark.sources.odata import ODataSource
from tidemark.spec import JOB_COLUMNS, JobSpec, read_jobs

SCHEMA = "id long, name string, amount double, ins timestamp_ntz, upd timestamp_ntz"


class Clock:
    def __init__(self):
        self.at = dt.datetime(2024, 6, 1)

    def __call__(self):
        self.at += dt.timedelta(seconds=1)
        return self.at


class Source:
    """Tables by object name, swapped between runs."""

    def __init__(self):
        self.tables, self.marks = {}, {}

    def __call__(self, spark, job, mark):
        self.marks[job.obj_name] = mark
        return self.tables[job.obj_name]


def ts(text):
    return dt.datetime.fromisoformat(text)


def job(name="people", **more):
    given = dict(src_db_name="postgresql", database_name="db", schema_name="public", obj_type="table", obj_name=name,
                 insrt_time_col="ins", updt_time_col="upd", primary_key_col="id", col_names="*", sf_tbl=f"tbl_{name}")
    return JobSpec(**{**given, **more})


def frame(spark, *rows, schema=SCHEMA):
    return spark.createDataFrame(list(rows), schema)


def state(loader, spec, *cols):
    return sorted((tuple(r) for r in loader.table(spec).read().select(*cols).collect()), key=repr)


def stamp_of(loader, run_id):
    return loader.control().where(F.col("RUN_ID") == run_id).first()["RUN_START"]


@pytest.fixture
def source():
    return Source()


@pytest.fixture
def loader(spark, tmp_path, source):
    return Loader(spark, str(tmp_path / "lake"), {"postgresql": source}, {"postgresql": lambda s, j, m: source.tables["gone"]}, clock=Clock())


def test_full_then_incremental(spark, loader, source):
    old = ts("2024-01-01 10:00:00")
    source.tables["people"] = frame(spark, (1, "a", 1.0, old, None), (2, "b", 2.0, old, None), (2, "b2", 2.5, old, ts("2024-01-02")))
    first = loader.full_load([job()])[0]
    assert (first.status, first.inserted, first.updated, first.deleted) == ("SUCCESS", 2, 0, 0)
    assert first.mark == ts("2024-01-02") and source.marks["people"] is None
    assert state(loader, job(), "id", "name") == [(1, "a"), (2, "b2")]

    # the lookback re-reads row 2; row 1 changed too early to be seen; row 3 is new
    source.tables["people"] = frame(
        spark, (1, "never seen", 1.0, old, None), (2, "b2", 2.5, old, ts("2024-01-02")), (3, "c", 3.0, ts("2024-01-03"), None))
    second = loader.incr_load([job()])[0]
    assert source.marks["people"] == ts("2024-01-01 23:50:00")
    assert (second.inserted, second.updated) == (1, 0) and second.mark == ts("2024-01-03")
    source.tables["people"] = frame(spark, (2, "b3", 2.5, old, ts("2024-01-04")))
    third = loader.incr_load([job()])[0]
    assert (third.inserted, third.updated) == (0, 1)
    assert state(loader, job(), "id", "name") == [(1, "a"), (2, "b3"), (3, "c")]
    assert [tuple(r) for r in loader.changed_keys(job(), stamp_of(loader, 3)).collect()] == [(2, "update")]
    stamps = {r.id: (r.EDW_INSERTED_TIMESTAMP, r.EDW_UPDATED_TIMESTAMP) for r in loader.table(job()).read().collect()}
    assert stamps[2][0] == stamps[1][0] < stamps[2][1] and stamps[1][1] is None
    assert loader.control().orderBy("RUN_ID").select("RUN_ID", "ROWS_INSERTED", "ROWS_UPDATED").collect() == [(1, 2, 0), (2, 1, 0), (3, 0, 1)]
    # the staging folder doubles as the archive
    assert spark.read.parquet(f"{loader.root}/stage/tbl_people").groupBy("load_ts").count().count() == 3


def test_full_load_keeps_rows_the_source_lost(spark, loader, source):
    source.tables["people"] = frame(spark, (1, "a", 1.0, ts("2024-01-01"), None))
    loader.full_load([job()])
    source.tables["people"] = frame(spark, (2, "b", 1.0, ts("2024-01-01"), None))
    loader.full_load([job()])
    assert state(loader, job(), "id") == [(1,), (2,)]


def test_failures_are_logged_and_isolated(spark, loader, source):
    good = frame(spark, (1, "a", 1.0, ts("2024-01-01"), None))
    source.tables = {"one": good, "three": good}
    done = loader.full_load([job("one"), job("two"), job("three")])
    assert [o.status for o in done] == ["SUCCESS", "FAILED", "SUCCESS"]
    source.tables = {"two": good, "one": good.withColumn("amount", F.raise_error(F.lit("boom")).cast("double"))}
    again = loader.incr_load([job("one"), job("two")])
    assert [o.status for o in again] == ["FAILED", "SUCCESS"] and "boom" in again[0].error
    # the failed run did not move the mark
    source.tables["one"] = good
    loader.incr_load([job("one")])
    assert source.marks["one"] == ts("2023-12-31 23:50:00")
    bad = failures(loader.control()).orderBy("RUN_ID").collect()
    assert [r.SOURCE_OBJECT_NAME for r in bad] == ["two", "one"] and bad[0].ERROR_MESSAGE.startswith("KeyError")
    summary = {r.table_name: (r.runs, r.failures) for r in run_summary(loader.control()).collect()}
    assert summary == {"TBL_ONE": (3, 1), "TBL_TWO": (2, 1), "TBL_THREE": (1, 0)}


def test_deletes_come_before_the_merge(spark, loader, source):
    at = ts("2024-01-01")
    source.tables["people"] = frame(spark, *[(i, "x", 1.0, at, None) for i in (1, 2, 3)])
    loader.full_load([job()])
    source.tables["people"] = frame(spark, (3, "x", 1.0, ts("2024-02-01"), None))
    source.tables["gone"] = frame(spark, (2, "", 0.0, at, None), (3, "", 0.0, at, None)).select("id", "ins")
    out = loader.incr_load([job(is_deletion="YES", deleted_tbl="people_deleted")])[0]
    assert (out.inserted, out.updated, out.deleted) == (1, 0, 2)
    assert state(loader, job(), "id") == [(1,), (3,)]
    # deletions count even when nothing else changed
    source.tables["people"] = frame(spark)
    source.tables["gone"] = frame(spark, (1, "", 0.0, ts("2024-03-01"), None)).select("id", "ins")
    out = loader.incr_load([job(is_deletion="yes", deleted_tbl="people_deleted")])[0]
    assert (out.error, out.inserted, out.deleted) == ("-", 0, 1) and state(loader, job(), "id") == [(3,)]


def test_master_tables_are_replaced(spark, loader, source):
    spec = job(master_tbl="yes")
    source.tables["people"] = frame(spark, (1, "a", 1.0, ts("2024-01-01"), None), (2, "b", 1.0, ts("2024-01-01"), None))
    loader.full_load([spec])
    source.tables["people"] = frame(spark, (2, "b", 1.0, ts("2024-01-01"), None), (2, "old", 1.0, ts("2023-01-01"), None))
    out = loader.full_load([spec])[0]
    assert (out.inserted, out.deleted) == (1, 0)
    assert state(loader, spec, "id", "name") == [(2, "b")]
    source.tables["people"] = frame(spark)
    assert loader.full_load([spec])[0].status == "SUCCESS" and state(loader, spec, "id") == [(2,)]
    assert loader.drop_old_stages(days=30) == []
    loader.clock.at += dt.timedelta(days=31)
    assert len(loader.drop_old_stages(days=30)) == 3


def test_new_columns_trigger_a_full_extract(spark, loader, source):
    source.tables["people"] = frame(spark, (1, "a", 1.0, ts("2024-01-01"), None), (2, "b", 1.0, ts("2024-02-01"), None))
    loader.full_load([job()])
    source.tables["people"] = source.tables["people"].withColumn("City", F.lit("x"))
    out = loader.incr_load([job()])[0]
    assert out.updated == 2 and source.marks["people"] is None
    assert state(loader, job(), "id", "City") == [(1, "x"), (2, "x")]


@pytest.mark.parametrize("allow", [False, True])
def test_lost_columns_are_dropped_only_on_request(spark, loader, source, allow):
    loader.allow_drop = allow
    source.tables["people"] = frame(spark, (1, "a", 1.0, ts("2024-01-01"), None))
    loader.full_load([job()])
    source.tables["people"] = frame(spark, (2, "b", 2.0, ts("2024-02-01"), None)).drop("amount")
    assert loader.incr_load([job()])[0].inserted == 1
    assert ("amount" in loader.table(job()).read().columns) is not allow


def test_empty_extract_creates_the_table(spark, loader, source):
    source.tables["people"] = frame(spark)
    out = loader.full_load([job()])[0]
    assert (out.status, out.inserted, out.mark) == ("SUCCESS", 0, None)
    assert loader.table(job()).read().count() == 0
    source.tables["people"] = frame(spark, (1, "a", 1.0, ts("2024-01-01"), None))
    assert loader.incr_load([job()])[0].inserted == 1


def test_synthetic_load_time_and_column_list(spark, loader, source):
    spec = job(insrt_time_col="inserted_timestamp", updt_time_col="inserted_timestamp", col_names="id, name")
    source.tables["people"] = frame(spark, (1, "a", 1.0, None, None), (2, "b", 1.0, None, None))
    loader.overrides = {("people", "id"): "string"}
    out = loader.full_load([spec])[0]
    assert out.inserted == 2 and out.mark == ts("2024-06-01 00:00:01")
    assert loader.table(spec).read().schema["id"].dataType.simpleString() == "string"
    assert loader.table(spec).read().columns[:3] == ["id", "name", "inserted_timestamp"]


def test_jobs_in_parallel_get_distinct_run_ids(spark, loader, source):
    loader.parallel = 4
    rows = frame(spark, (1, "a", 1.0, ts("2024-01-01"), None))
    source.tables = {f"t{i}": rows for i in range(6)}
    done = loader.full_load([job(f"t{i}") for i in range(6)])
    assert all(o.inserted == 1 for o in done)
    assert sorted(r.RUN_ID for r in loader.control().collect()) == [1, 2, 3, 4, 5, 6]


def test_documents(spark, tmp_path):
    def land(text):
        (tmp_path / "members").write_text(text)

    land('{"_id":"1","createdAt":"2024-01-01 00:00:00","updatedAt":"NaT","w":{"b":1}}\n'
         '{"_id":"2","createdAt":"2024-01-01 00:00:00","w":{"b":2}}\n'
         '{"updatedAt":"2024-01-02 00:00:00.5","w":{"b":3},"_id":"2","createdAt":"2024-01-01 00:00:00"}\n')
    spec = job("members", src_db_name="mongodb", obj_type="collection", primary_key_col="_id",
               insrt_time_col="createdAt", updt_time_col="updatedAt")
    loader = Loader(spark, str(tmp_path / "lake"), {"mongodb": readers.landed_documents(str(tmp_path))}, clock=Clock())
    assert loader.full_load([spec])[0].inserted == 2
    assert state(loader, spec, "_id", F.get_json_object(DOCUMENT, "$.w.b")) == [("1", "1"), ("2", "3")]
    # same document with other key order: no change; the other one changes
    land('{"w":{"b":3},"createdAt":"2024-01-01 00:00:00","_id":"2","updatedAt":"2024-01-02 00:00:00.5"}\n'
         '{"_id":"1","createdAt":"2024-01-01 00:00:00","updatedAt":"2024-01-05 00:00:00","w":{"b":9}}\n')
    out = loader.incr_load([spec])[0]
    assert (out.inserted, out.updated, out.mark) == (0, 1, ts("2024-01-05"))


def test_numbers_of_documents_are_loaded_as_text(spark, tmp_path):
    (tmp_path / "members").write_text('{"_id":"1","at":"2024-01-01 00:00:00","w":[{"b":1,"c":1},{"b":"x"}]}\n'
                                      '{"_id":"2","at":"2024-01-01 00:00:00","w":{"b":2.5,"c":2}}\n')
    spec = job("members", src_db_name="mongodb", obj_type="collection", primary_key_col="_id", insrt_time_col="at", updt_time_col="at")
    loader = Loader(spark, str(tmp_path / "lake"), {"mongodb": readers.landed_documents(str(tmp_path))}, clock=Clock(), as_text={"Members": ["w.b"]})
    assert loader.full_load([spec])[0].inserted == 2
    assert state(loader, spec, "_id", F.get_json_object(DOCUMENT, "$.w")) == [("1", '[{"b":"1","c":1},{"b":"x"}]'), ("2", '{"b":"2.5","c":2}')]


def test_files(spark, tmp_path):
    """A sheet: found by name, cleaned, typed by its values, then loaded past the mark."""
    folder = tmp_path / "in"
    folder.mkdir()

    def land(body):
        (folder / "x_ItemList_2024.csv").write_text('"Mat.Code ", Name ,added_date,Qty\n' + body)

    spec = job("itemlist", src_db_name=None, obj_type="FILE", primary_key_col="Mat.Code", insrt_time_col="added_date",
               updt_time_col="added_date", col_names=None)
    loader = Loader(spark, str(tmp_path / "lake"), {"file": readers.sheets(str(folder), "*.csv")}, clock=Clock())
    land('A1,  pin ,2024-01-01 10:00:00,5\nA2,"bolt\t",2024-01-02 10:00:00,6\n')
    first = loader.full_load([spec])[0]
    assert (first.error, first.inserted, first.mark) == ("-", 2, ts("2024-01-02 10:00:00"))
    table = loader.table(spec).read()
    assert [f.dataType.simpleString() for f in table.schema.fields[:4]] == ["string", "string", "timestamp_ntz", "bigint"]
    land('A1,pin,2024-01-01 10:00:00,5\nA2,bolt,2024-01-02 10:00:00,7\nA3,nut,2024-01-03 00:00:00,1\n')
    out = loader.incr_load([spec])[0]
    assert (out.inserted, out.updated) == (1, 1)
    assert state(loader, spec, F.col("`Mat.Code`"), "Name", "Qty") == [("A1", "pin", 5), ("A2", "bolt", 7), ("A3", "nut", 1)]


def test_job_table(spark, tmp_path):
    path = tmp_path / "jobs.csv"
    path.write_text(
        ",".join(JOB_COLUMNS) + "\n"
        '1,SAP_ODATA,DB,SH,http://host/DELTA/,TABLE,OneSet,inserted_timestamp,inserted_timestamp,"Client,Order, Item",*,NO,,ONE,OneSet,\'A\' eq \'1\' and \'DATE\' eq ,?c=1,yes\n'
        "2,sqlserver,d,dbo,-,table,two,a,b,id,*,YES,two_del,TWO,-,-,-\n"
        ",,,,,,,,,,,,,,,,,\n\n")
    one, two = read_jobs(spark, str(path))
    assert one.keys == ["Client", "Order", "Item"] and one.filter_value.endswith("eq ") and one.is_master and not one.deletes
    assert two.deletes and two.service_url is None and two.master_tbl is None
    old = tmp_path / "old.csv"
    old.write_text("CONTROL_ID,SRC_DB_NAME,OBJ_NAME,OBJ_TYPE,SF_TBL,PRIMARY_KEY_COL\n1,sqlserver,x,table,X,id\n")
    assert read_jobs(spark, str(old))[0].sf_tbl == "X"


def test_tables_without_a_time_go_by_snapshots(spark, loader, source):
    spec = job(insrt_time_col=None, updt_time_col=None)
    rows = frame(spark, *[(i, "x", float(i), None, None) for i in range(5)]).select("id", "name", "amount")
    source.tables["people"] = rows
    assert loader.full_load([spec])[0].inserted == 5
    changed = rows.withColumn("amount", F.when(F.col("id") == 2, None).otherwise(F.col("amount"))).where("id <> 4")
    # a load that fails after the snapshot was written must not lose the change
    source.tables["people"] = changed.unionAll(changed.select("id", "name", F.lit(1.0)).where("id = 0"))
    keys = spec.keys
    broken = loader.incr_load([job(insrt_time_col=None, updt_time_col=None, primary_key_col="no_such_column")])[0]
    assert broken.status == "FAILED" and keys == ["id"]
    source.tables["people"] = changed
    out = loader.incr_load([spec])[0]
    assert (out.error, out.inserted, out.updated) == ("-", 0, 1)
    stage = sorted(spark.read.parquet(f"{loader.root}/stage/tbl_people").select("load_ts").distinct().collect())[-1][0]
    assert spark.read.parquet(f"{loader.root}/stage/tbl_people").where(F.col("load_ts") == stage).count() == 1
    again = loader.incr_load([spec])[0]
    assert (again.status, again.inserted, again.updated) == ("SUCCESS", 0, 0)


def test_an_increment_without_news_writes_no_version(spark, loader, source):
    at = ts("2024-01-01")
    big = spark.range(100_000).selectExpr(
        "id", "uuid() AS name", "1.0D AS amount", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id % 1000) AS ins",
        "CAST(NULL AS timestamp_ntz) AS upd")
    source.tables["people"] = big
    loader.full_load([job()])
    late = loader.table(job()).read().where("id < 2000 and id % 1000 >= 900").drop("EDW_INSERTED_TIMESTAMP", "EDW_UPDATED_TIMESTAMP")
    source.tables["people"] = late
    out = loader.incr_load([job()])[0]
    assert (out.error, out.inserted, out.updated, out.deleted) == ("-", 0, 0, 0) and out.mark > at
    assert loader.table(job()).versions() == [1]
    source.tables["people"] = late.withColumn("amount", F.col("amount") + F.col("id") % 2)
    assert loader.incr_load([job()])[0].updated == 100
    assert loader.table(job()).versions() == [1, 2]


def test_control_log_is_compacted(spark, loader, source):
    source.tables["people"] = frame(spark, (1, "a", 1.0, ts("2024-01-01"), None))
    for _ in range(3):
        loader.full_load([job()])
    loader.compact_control()
    loader.incr_load([job()])
    assert source.marks["people"] == ts("2023-12-31 23:50:00")
    assert [r.RUN_ID for r in loader.control().orderBy("RUN_ID").collect()] == [1, 2, 3, 4]
    assert len(loader.control().inputFiles()) == 2


def test_bucketed_targets(spark, tmp_path, source):
    loader = Loader(spark, str(tmp_path / "lake"), {"postgresql": source}, buckets=4, clock=Clock())
    spec = job(f"b{tmp_path.name}")
    source.tables[spec.obj_name] = frame(spark, *[(i, "x", 1.0, ts("2024-01-01"), None) for i in range(50)])
    loader.full_load([spec])
    source.tables[spec.obj_name] = frame(spark, *[(i, "y", 1.0, ts("2024-02-01"), None) for i in range(40, 60)])
    out = loader.incr_load([spec])[0]
    assert (out.error, out.inserted, out.updated) == ("-", 10, 10)
    assert loader.table(spec).read().count() == 60


def service():
    """A delta service: answers with the entities of the asked day, or with all."""
    metadata = """<edmx:Edmx xmlns:edmx="http://schemas.microsoft.com/ado/2007/06/edmx"><edmx:DataServices>
        <Schema xmlns="http://schemas.microsoft.com/ado/2008/09/edm"><EntityType Name="Address">
        <Property Name="Client" Type="Edm.String"/><Property Name="Nr" Type="Edm.Int32"/><Property Name="Day" Type="Edm.DateTime"/>
        <Property Name="Tags" Type="Edm.String"/></EntityType></Schema></edmx:DataServices></edmx:Edmx>"""

    class Service(ODataSource):
        @classmethod
        def name(cls):
            return "loader_odata"

        @staticmethod
        def fetch(url, options):
            if "$metadata" in url:
                return metadata.encode()
            import json
            import re

            import urllib.parse

            rows = [{"Client": "1", "Nr": i, "Day": "/Date(%d)/" % (1704067200000 + 86400000 * i), "Tags": [i]} for i in range(7)]
            if "DATE" in url:
                rows = [dict(rows[6], Tags="changed")]
            if "/$count" in url:
                return str(len(rows)).encode()
            if "$select" in url:  # asked for the key at a quantile; all have the same
                return json.dumps({"d": {"results": [{"Client": "1"}]}}).encode()
            asked = urllib.parse.unquote(url)
            if "Client lt" in asked or "Client eq null" in asked:
                rows = []
            skip, top = int(re.search(r"skip=(\d+)", url)[1]), int(re.search(r"top=(\d+)", url)[1])
            return json.dumps({"d": {"results": rows[skip:skip + top]}}).encode()

    return Service


def test_odata_delta_service(spark, tmp_path):
    spec = job("AddressSet", src_db_name="SAP_ODATA", service_url="http://h/DELTA_SRV/", entity_value="AddressSet", client="?c=1",
               primary_key_col="Client,Nr", insrt_time_col="Day", updt_time_col="Day", sf_tbl="ADDRESS")
    loader = Loader(spark, str(tmp_path / "lake"), {"sap_odata": readers.entities(service=service(), page=3)}, clock=Clock())
    first = loader.full_load([spec])[0]
    assert (first.error, first.inserted, first.mark) == ("-", 7, ts("2024-01-07"))
    # even a full load asks a delta service for changes only
    second = loader.full_load([spec])[0]
    assert (second.error, second.inserted, second.updated) == ("-", 0, 1)
    assert ("1", 6, "changed") in state(loader, spec, "Client", "Nr", "Tags")


def test_relational_reader_asks_for_the_right_tables(spark, monkeypatch):
    asked = []
    rows = frame(spark, (1, "a", 1.0, ts("2024-01-01"), None), (2, "b", 1.0, ts("2024-02-01"), None))
    monkeypatch.setattr(readers.jdbc, "read_table", lambda s, o, table, cols=None, split=None: asked.append((table, cols, split)) or rows)
    monkeypatch.setattr(readers.jdbc, "read_slices", lambda s, o, table, name, n, cols=None, past=None, source=None: asked.append((table, name, n, cols, past)) or rows)
    spec = job(is_deletion="yes", deleted_tbl="people_deleted", col_names="id, name")
    readers.relational("postgresql", {"url": "x"}, {"people": "id"}, partitions=4)(spark, spec, None)
    feed = readers.relational_deletes("postgresql", {"url": "x"})(spark, spec, "2024-01-15 00:00:00")
    readers.relational("postgresql", {"url": "x"}, partitions=1)(spark, spec, None)
    whole = ("public.people", "id, name", None)
    assert asked == [whole, ("public.people", "id", 4, "id, name", None), ("public.people_deleted", None, None), whole]
    assert [tuple(r) for r in feed.collect()] == [(2, ts("2024-02-01"))]


def test_relational_reader_splits_by_numbers_and_times_only(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(readers.jdbc, "read_slices", lambda s, o, table, name, n, cols=None, past=None, source=None: asked.append((name, past)))
    tables = {"text": "code string, Changed timestamp_ntz", "mixed": "code string, Nr bigint, Changed timestamp_ntz"}
    monkeypatch.setattr(readers.jdbc, "read_table", lambda s, o, table, cols=None, split=None: s.createDataFrame([], tables[table.split(".")[1]]))
    read = readers.relational("sqlserver", {"url": "x"})
    for name, keys in (("text", "code"), ("text", "missing"), ("mixed", "code, nr")):
        read(spark, job(name, primary_key_col=keys, insrt_time_col="changed", updt_time_col=None), ts("2024-01-15"))
    assert asked == [("Nr", "(\"Changed\" > CAST('2024-01-15 00:00:00' AS DATETIME2))")]


def test_collection_reader_gives_whole_documents(spark, tmp_path, monkeypatch):
    schema = "_id string, createdAt timestamp_ntz, updatedAt timestamp_ntz, wallet struct<balance:double>"
    rows = frame(spark, ("1", ts("2024-01-01"), None, (1.5,)), ("2", ts("2024-01-02"), ts("2024-01-03 10:00:00.25"), None), schema=schema)
    monkeypatch.setattr(readers.documents, "read_collection", lambda s, uri, db, name, mark, **times: rows)
    spec = job("members", src_db_name="mongodb", obj_type="collection", primary_key_col="_id", insrt_time_col="createdAt", updt_time_col="updatedAt")
    loader = Loader(spark, str(tmp_path / "lake"), {"mongodb": readers.collection("uri")}, clock=Clock())
    out = loader.full_load([spec])[0]
    assert (out.error, out.inserted, out.mark) == ("-", 2, ts("2024-01-03 10:00:00.25"))
    assert state(loader, spec, "_id", F.get_json_object(DOCUMENT, "$.wallet.balance")) == [("1", "1.5"), ("2", None)]


def test_master_with_a_feed_keeps_its_rows_when_nothing_arrives(spark, tmp_path, source):
    rows = frame(spark, (1, "a", 1.0, ts("2024-01-01"), None), (2, "b", 1.0, ts("2024-01-01"), None))
    feed = frame(spark, (1, ts("2024-01-01")), schema="id long, gone timestamp_ntz")
    loader = Loader(spark, str(tmp_path / "lake"), {"postgresql": source}, {"postgresql": lambda s, j, m: feed}, clock=Clock())
    spec = job("master", master_tbl="yes", is_deletion="yes", deleted_tbl="gone")
    source.tables["master"] = rows
    loader.full_load([spec])
    source.tables["master"] = rows.limit(0)
    out = loader.incr_load([spec])[0]
    assert (out.status, out.deleted) == ("SUCCESS", 0) and loader.table(spec).read().count() == 2


def test_jobs_of_one_target_run_in_order(spark, tmp_path, source):
    loader = Loader(spark, str(tmp_path / "lake"), {"postgresql": source}, parallel=8, clock=Clock())
    specs = [job(f"part{i}", sf_tbl="TBL_WHOLE") for i in range(4)] + [job("alone")]
    for i in range(4):
        source.tables[f"part{i}"] = frame(spark, *[(100 * i + k, "x", 1.0, ts("2024-01-01"), None) for k in range(50)])
    source.tables["alone"] = source.tables["part0"]
    done = loader.full_load(specs)
    assert [(o.job.obj_name, o.status, o.inserted) for o in done] == [(s.obj_name, "SUCCESS", 50) for s in specs]
    assert loader.table(specs[0]).read().count() == 200


def test_documents_with_iso_times_are_loaded(spark, tmp_path):
    folder = tmp_path / "docs" / "members"
    folder.mkdir(parents=True)
    lines = ['{"_id":"1","createdAt":"2024-02-01T00:00:00Z"}', '{"_id":"2","createdAt":"2024-02-01T05:30:00+05:30"}', '{"_id":"3","createdAt":"2024-02-01 00:00:00"}']
    (folder / "a.json").write_text("\n".join(lines))
    spec = job("members", src_db_name="mongodb", obj_type="collection", primary_key_col="_id", insrt_time_col="createdAt", updt_time_col="createdAt")
    loader = Loader(spark, str(tmp_path / "lake"), {"mongodb": readers.landed_documents(str(tmp_path / "docs"))}, clock=Clock())
    out = loader.full_load([spec])[0]
    assert (out.error, out.inserted, out.mark) == ("-", 3, ts("2024-02-01"))
    (folder / "b.json").write_text('{"_id":"4","createdAt":"yesterday"}')
    assert loader.full_load([spec])[0].status == "FAILED" and loader.table(spec).read().count() == 3


def test_relational_rows_take_the_types_of_the_catalog(spark, monkeypatch):
    rows = spark.createDataFrame([("7", "1.25")], "id string, price string")
    monkeypatch.setattr(readers.jdbc, "read_table", lambda *a, **k: rows)
    monkeypatch.setattr(readers.jdbc, "read_query", lambda s, o, query, split=None: s.createDataFrame(
        [("price", "float8", 2), ("id", "int8", 1)], "column_name string, data_type string, ordinal_position int"))
    got = readers.relational("postgresql", {"url": "x"}, type_map=TypeMap())(spark, job(), None)
    assert got.schema.simpleString() == "struct<id:bigint,price:double>"


def test_control_append_logs_all_runs_in_one_write(spark, sf_dir, monkeypatch):
    """Runs grow with the table's days; no run is written by itself."""
    from tidemark.workload import landing

    written = []
    append = Loader._append
    monkeypatch.setattr(Loader, "_append", lambda self, runs: (written.append(runs), append(self, runs)))
    landing.control_append(spark, sf_dir)
    days = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderpriority", "o_orderdate").distinct().count()
    assert len(written) == 1 and written[0].count() == days > 1000


def test_filters_of_one_entity_set_do_not_reach_the_next(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(readers.odata, "read_entities", lambda spark, names, service, **options: asked.append(options) or "rows")
    monkeypatch.setattr(readers.odata, "typed_entities", lambda rows, types, type_map: rows)
    base = service()
    metadata = base.fetch("http://h/$metadata", {}).decode()

    class Service(base):
        @staticmethod
        def fetch(url, options):
            return metadata.replace("Address", "A" if "/a/" in url else "B").encode()

    read = readers.entities(service=Service, splits={"ASet": ["Nr lt 3", "Nr ge 3"]}, page=3)
    for name in ("b", "a", "b"):
        spec = job(f"{name}Set", src_db_name="SAP_ODATA", service_url=f"http://h/{name}/", entity_value=f"{name.upper()}Set", primary_key_col="Nr")
        assert read(spark, spec, None) == "rows"
    assert ["splits" in o for o in asked] == [False, True, False]
    assert [(o["parallel"], o["range_key"], o["range_type"]) for o in asked] == [("8", "Nr", "Edm.Int32")] * 3


def test_the_log_is_read_once_per_load(spark, tmp_path, source, monkeypatch):
    """Marks and run numbers noted in memory are those that a new reading of the log gives."""
    from tidemark.operators.increment import Marks, last_mark

    loader = Loader(spark, str(tmp_path / "lake"), {"postgresql": source}, clock=Clock())
    specs = [job("one"), job("two"), job("bad"), job("one")]
    source.tables["one"] = frame(spark, (1, "a", 1.0, ts("2024-01-01"), ts("2024-02-01 10:00:00.5")))
    source.tables["two"] = frame(spark)
    reads, control = [], Loader.control
    monkeypatch.setattr(Loader, "control", lambda self: reads.append(1) or control(self))
    done = loader.incr_load(specs)
    assert [o.status for o in done] == ["SUCCESS", "SUCCESS", "FAILED", "SUCCESS"] and len(reads) == 1
    assert source.marks["one"] == ts("2024-02-01 09:50:00.5")  # the second job of one object sees the first one's mark
    again = Marks(control(loader))
    assert (again.last_run, again._marks) == (loader._marks.last_run, loader._marks._marks) and again.last_run == 4
    for spec in specs:
        names = (spec.source, spec.obj_type, spec.obj_name, spec.sf_tbl)
        assert last_mark(loader._marks, *names) == last_mark(control(loader), *names)
