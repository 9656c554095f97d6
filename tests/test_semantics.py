"""Traps: null collisions, ambiguous keys, null order, type lookup, parsing."""

import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F, types as T

from tidemark.functions import documents, names, rows, text, times
from tidemark.functions.typemap import TypeMap, cast_to, default_rows, failed_casts, read_type_map, system_of, target_schema
from tidemark.operators import merge as m
from tidemark.operators.evolve import drift, evolve, evolve_drop
from tidemark.operators.snapshot import hash_archive, snapshot_diff, snapshot_diff_by_hash
from tidemark.sources.odata import filter_text


def test_row_hash_keeps_nulls_and_separators_apart(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a_b", "c"), ("a", "b_c")], "x string, y string")
    assert df.select(rows.row_hash(df)).distinct().count() == 4


def test_change_test_sees_swapped_nulls(spark):
    df = spark.createDataFrame([("a", None, None, "a"), ("a", None, "a", None)], "x string, y string, p string, q string")
    got = [r[0] for r in df.selectExpr(rows.differs(["x", "y"], ["p", "q"])).collect()]
    assert got == [True, False]


def test_delete_matches_columns_not_concatenation(spark):
    target = m.with_stamps(spark.createDataFrame([("1", "23"), ("12", "3"), (None, "1")], "a string, b string"), "2020-01-01 00:00:00")
    feed = spark.createDataFrame([("1", "23"), (None, "1")], "a string, b string")
    assert sorted((r.a or "", r.b) for r in m.delete_by_feed(target, feed, ["a", "b"]).collect()) == [("", "1"), ("12", "3")]


def test_documents_compare_by_value(spark):
    df = spark.createDataFrame([('{"b":1,"a":2}', '{"a":2,"b":1}'), ('{"a":1}', '{"a":1,"b":null}')], "x string, y string")
    got = df.select((documents.canonical(F.parse_json("x")) == documents.canonical(F.parse_json("y"))).alias("same")).collect()
    assert [r.same for r in got] == [True, False]


def test_merge_compares_variant_and_map_columns(spark):
    df = spark.sql("""select 1 as k, parse_json('{"a":1,"b":2}') as doc, map('x', 1, 'y', 2) as tags""")
    same = spark.sql("""select 1 as k, parse_json('{"b":2,"a":1}') as doc, map('y', 2, 'x', 1) as tags""")
    other = spark.sql("""select 1 as k, parse_json('{"b":2,"a":1}') as doc, map('y', 2, 'x', 3) as tags""")
    target = m.with_stamps(df, "2020-01-01 00:00:00")
    assert m.merge(target, same, ["k"], "2030-01-01 00:00:00").first()["_action"] == "keep"
    assert m.merge(target, other, ["k"], "2030-01-01 00:00:00").first()["_action"] == "update"


def test_snapshot_diff_of_semi_structured_rows(spark):
    old = spark.sql("""select 1 as k, parse_json('{"a":1,"b":2}') as doc, map('x', 1, 'y', 2) as tags, struct(map('z', 1) as m) as s""")
    same = spark.sql("""select 1 as k, parse_json('{"b":2,"a":1}') as doc, map('y', 2, 'x', 1) as tags, struct(map('z', 1) as m) as s""")
    new = spark.sql("""select 1 as k, parse_json('{"b":2,"a":5}') as doc, map('y', 2, 'x', 1) as tags, struct(map('z', 7) as m) as s""")
    assert snapshot_diff(same, old).count() == 0
    diff = snapshot_diff(new, old)
    assert diff.schema.simpleString() == new.schema.simpleString()
    assert diff.selectExpr("variant_get(doc, '$.a', 'int')", "tags['y']", "s.m['z']").first()[:] == (5, 2, 7)
    assert snapshot_diff_by_hash(same, hash_archive(old)).count() == 0
    assert snapshot_diff_by_hash(new, hash_archive(old)).count() == 1


def test_json_null_is_null(spark):
    df = spark.sql("""select parse_json('{"u":null,"n":{"x":5}}') as d""")
    assert tuple(df.select(documents.field(F.col("d"), "u"), documents.field(F.col("d"), "n.x", "int"),
                           documents.field(F.col("d"), "gone")).first()) == (None, 5, None)


def test_nested_numbers_become_text_only_where_present(spark):
    df = spark.createDataFrame([(1, ((5,), "o")), (2, (None, "p")), (3, None)],
                               "id int, rewards struct<GO:struct<balance:int>,owner:string>")
    out = documents.nested_to_text(df, ["rewards.GO.balance", "rewards.GO.absent", "rewards.owner", "x.y"])
    assert out.schema["rewards"].dataType["GO"].dataType.simpleString() == "struct<balance:string>"
    assert [(r.rewards.GO.balance if r.rewards and r.rewards.GO else None) for r in out.orderBy("id").collect()] == ["5", None, None]
    assert [r.rewards is None for r in out.orderBy("id").collect()] == [False, False, True]


def test_strip_equals_python(spark):
    samples = ["  a b ", "\t\na\r", "　x\xa0", "", " ", "y\x1f", " z z ", None]
    got = spark.createDataFrame([(s,) for s in samples], "s string").select(text.strip(F.col("s")).alias("s")).collect()
    assert [r.s for r in got] == [s if s is None else s.strip() for s in samples]


def test_two_time_formats(spark):
    samples = ["2024-01-02 03:04:05", "2024-1-2 3:4:5.25", "2024-01-02 03:04:05.123456", "NaT", None, "2024-01-02", "02/01/2024",
               "2024-13-02 03:04:05", "2024-01-02 03:04:05.1234567"]

    def python(s):
        if s is None or s == "NaT":
            return None, False
        for f in ("%Y-%m-%d %H:%M:%S.%f", "%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S"):
            try:
                return dt.datetime.strptime(s, f), False
            except ValueError:
                continue
        return None, True

    df = spark.createDataFrame([(s,) for s in samples], "s string")
    got = df.select(times.parse(F.col("s")), times.unparsed(F.col("s"))).collect()
    assert [tuple(r) for r in got] == [python(s) for s in samples]
    with pytest.raises(Exception, match="unreadable time"):
        df.select(times.parse(F.col("s"), strict=True)).collect()


def test_times_do_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.createDataFrame([("2024-03-10 02:30:00",)], "s string")  # inside the daylight-saving gap
        t = times.parse(F.col("s"))
        got = df.select(t, times.shift_zone(t, "Asia/Kolkata")).first()
        assert [str(v) for v in got] == ["2024-03-10 02:30:00", "2024-03-10 08:00:00"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_now_in_a_zone(spark):
    utc, local = spark.range(1).select(times.now(), times.now("Asia/Kolkata")).first()
    assert local - utc == dt.timedelta(hours=5, minutes=30)
    assert abs(utc - dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)) < dt.timedelta(minutes=1)


def test_synthetic_time_is_added_once(spark):
    df = times.stamp_column(spark.range(1), "inserted_timestamp", "2030-01-01 00:00:00")
    assert times.stamp_column(df, "inserted_timestamp", "2031-01-01 00:00:00").first()["inserted_timestamp"] == dt.datetime(2030, 1, 1)


def test_headers():
    assert names.clean_header(" Mat.\nCode    x  y ") == "Mat.Code x  y"
    assert names.split_list("Client, Order,Item") == ["Client", "Order", "Item"]
    assert names.quote("a`b.c") == "`a``b.c`"


def test_clashing_headers_are_refused(spark):
    with pytest.raises(ValueError, match="collide"):
        names.clean_headers(spark.createDataFrame([(1, 2)], ["A ", "a"]))


@pytest.mark.parametrize("system, source, default, strict", [
    ("postgresql", "INT8", "bigint", "decimal(38,0)"),
    ("postgresql", "numeric(12,2)", "decimal(12,2)", "decimal(38,0)"),
    ("postgresql", "jsonb", "variant", "variant"),
    ("postgresql", "text", "string", "string"),
    ("postgresql", "double precision", "double", "string"),
    ("postgresql", "timestamp with time zone", "timestamp", "string"),
    ("sqlserver", "text", "string", "variant"),
    ("sqlserver", "varchar", "string", "string"),
    ("sqlserver", "smallint", "bigint", "decimal(38,0)"),
    ("sqlserver", "bit", "boolean", "boolean"),
    ("sqlserver", "real", "double", "string"),
    ("sqlserver", "geography", "string", "string"),
    ("excel", "int64", "bigint", "string"),
    ("excel", "float64", "double", "string"),
    ("excel", "datetime64[ns]", "timestamp_ntz", "timestamp_ntz"),
    ("sap_odata", "Edm.Decimal", "double", "double"),
    ("sap_odata", "Edm.Decimal(10,3)", "decimal(10,3)", "double"),
    ("sap_odata", "edm.datetime", "timestamp_ntz", "timestamp_ntz"),
    ("sap_odata", "Edm.Time", "timestamp", "timestamp"),
])
def test_type_lookup(system, source, default, strict):
    assert TypeMap().resolve(system, source).spark == default
    assert TypeMap().resolve(system, source, strict=True).spark == strict


def test_unknown_types_are_reported_and_overrides_apply():
    assert not TypeMap().resolve("sqlserver", "hierarchyid").matched
    overridden = TypeMap(overrides={("Survey", "added_by"): "varchar"})
    assert overridden.resolve("sqlserver", "int", table="survey", name="ADDED_BY").spark == "string"
    assert system_of("sqlserver", "FILE") == "EXCEL" and system_of("sap_odata") == "SAP_ODATA"


def test_target_schema_is_never_shorter_than_the_catalog():
    schema = target_schema([("a", "int"), ("b", "hierarchyid"), ("c", "date")], "sqlserver", TypeMap())
    assert schema.simpleString() == "struct<a:bigint,b:string,c:date>"


def test_type_map_from_csv_takes_the_first_match(spark, tmp_path):
    path = tmp_path / "types.csv"
    path.write_text("POSTGRESQL,SQLSERVER,SNOWFLAKE\nint4,smallint,number\ntext,smallint,varchar\n,nvarchar,varchar\n")
    rows_ = read_type_map(spark, str(path))
    assert ("SQLSERVER", "smallint", "number") in rows_ and ("SQLSERVER", "smallint", "varchar") not in rows_
    assert TypeMap(rows_).resolve("sqlserver", "nvarchar").matched
    assert len({(s, t.lower()) for s, t, _ in default_rows()}) == len(default_rows())


def test_casts(spark):
    df = spark.createDataFrame([("1", "x", '{"a":1}')], "n string, d string, j string")
    schema = T.StructType().add("n", "long").add("D", T.DecimalType(10, 2)).add("j", T.VariantType()).add("new", "date")
    row = cast_to(df, schema, strict=False).first()
    assert row["n"] == 1 and row["D"] is None and row["new"] is None
    assert df.select(failed_casts(df, schema)).first()[0] == 1
    with pytest.raises(Exception):
        cast_to(df, schema, strict=True).collect()
    exact = spark.createDataFrame([("12.34",)], "x string")
    assert cast_to(exact, T.StructType().add("x", T.DecimalType(10, 2))).first()["x"] == decimal.Decimal("12.34")


def test_drift_and_evolution(spark):
    assert drift(["A", "new"], ["a", "gone", "EDW_INSERTED_TIMESTAMP", "EDW_UPDATED_TIMESTAMP"]) == (["new"], ["gone"])
    target = m.with_stamps(spark.createDataFrame([(1, "x")], "a int, gone string"), "2020-01-01 00:00:00")
    grown, reload = evolve(target, spark.createDataFrame([], "a int, new double").schema, allow_drop=True)
    assert reload and grown.columns == ["a", "gone", "new", m.INSERTED, m.UPDATED]
    shrunk, reload = evolve(target, spark.createDataFrame([], "a int").schema, allow_drop=True)
    assert not reload and shrunk.columns == ["a", m.INSERTED, m.UPDATED]
    kept, _ = evolve(target, spark.createDataFrame([], "a int").schema)
    assert "gone" in kept.columns
    with pytest.raises(ValueError, match="allow_drop"):
        evolve_drop(target, ["gone"])


@pytest.mark.parametrize("given, url, mark, want", [
    ("'P' eq '1' and 'DATE' eq ", "x", "20240101", "'P' eq '1' and 'DATE' eq '20240101'"),
    ("'P' eq '1'", "DELTA", "20240101", "'P' eq '1'"),
    (None, "plain", "20240101", None),
    (None, "ORDERS_DELTA", "20240101", "'DATE' eq '20240101'"),
    ("'P' eq '1' and 'DATE' eq ", "x", None, "'P' eq '1'"),
    ("'DATE' eq ", "x", None, None),
    (None, "ORDERS_DELTA", None, None),
])
def test_odata_filters(given, url, mark, want):
    assert filter_text(given, url, mark) == want


def test_numbers_in_documents_become_text(spark):
    import json

    from tidemark.functions.documents import numbers_to_text

    documents = [
        {"a": {"b": 1, "c": 2}, "z": None}, {"a": {"b": -1.5}}, {"a": {"b": "1"}}, {"a": {"b": None}}, {"a": {"b": {"b": 3}}}, {"a": {"b": True}}, {"a": 5},
        {"a": [{"b": 1, "x": [1, {"b": 2}]}, {"c": 1}, 4, None, "b"]}, [{"a": {"b": 9}}, {"a": [{"b": 8}]}], 7, "text", [], {}, {"b": 1, "a": {}}, None]

    def plain(v, keys):
        if not keys:
            return json.dumps(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v
        if isinstance(v, list):
            return [plain(x, keys) if isinstance(x, dict) else x for x in v]
        return {k: plain(x, keys[1:]) if k == keys[0] else x for k, x in v.items()} if isinstance(v, dict) else v

    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(documents)] + [(99, None)], "i int, t string")
    got = {r.i: r.t for r in df.select("i", F.to_json(numbers_to_text(F.parse_json("t"), ["a.b", "no.such"])).alias("t")).collect()}
    assert got.pop(99) is None
    assert {i: json.loads(t) if t is not None else None for i, t in got.items()} == {i: plain(d, ["a", "b"]) for i, d in enumerate(documents)}


def test_documents_are_computed_once_for_all_paths(spark):
    """Each path used to compute its document five times, so the work was five to the power of the number of paths."""
    import json

    from tidemark.functions.documents import numbers_to_text

    paths = ["a.b", "a.b.c", "a", "a.b", "d.e", "d.f.g.h", "no.such", "d.f"]
    documents = [
        ({"a": 1, "d": 2, "f": 3}, {"a": "1", "d": 2, "f": 3}), ({"a": [1, {"b": 2.5, "c": 1}]}, {"a": [1, {"b": "2.5", "c": 1}]}),
        ({"a": {"b": {"c": 1, "b": 1}}, "x": None}, {"a": {"b": {"c": "1", "b": 1}}, "x": None}), ({"a": {"b": [{"c": 1}, 2, None]}}, {"a": {"b": [{"c": "1"}, 2, None]}}),
        ({"d": [{"e": 1, "f": 2}, {"f": [{"g": {"h": 3}}, {"g": [[{"h": 4}], {"h": 5}]}]}, []]}, {"d": [{"e": "1", "f": "2"}, {"f": [{"g": {"h": "3"}}, {"g": [[{"h": 4}], {"h": "5"}]}]}, []]}),
        ([{"a": 1}, {"d": {"e": True}}, 3], [{"a": "1"}, {"d": {"e": True}}, 3]), (8, 8), (None, None)]
    df = spark.createDataFrame([(i, json.dumps(d)) for i, (d, _) in enumerate(documents)] + [(99, None)], "i int, t string")
    for some in (paths[:2], paths):
        done = df.select("i", F.to_json(numbers_to_text(F.parse_json("t"), some)).alias("t"))
        plan = done._jdf.queryExecution().optimizedPlan().toString().lower()
        assert plan.count("parsejson") + plan.count("parse_json") == 1 and len(plan) < 20_000
    got = {r.i: r.t for r in done.collect()}
    assert got.pop(99) is None
    assert {i: json.loads(t) for i, t in got.items()} == {i: want for i, (_, want) in enumerate(documents)}
    text = spark.range(1).select(F.to_json(numbers_to_text(F.parse_json(F.lit('{"a":1}')), [])).alias("t"))
    assert text.first().t == '{"a":1}'
