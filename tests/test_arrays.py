"""Large JSON array files, read in blocks."""

import json
import random

import pytest

from tidemark.sources.documents import read_arrays, read_large_arrays


def odd_values(n, seed=1):
    r = random.Random(seed)
    bits = ['{', '}', '[', ']', '"', '\\', ',', '\n', 'é', '😀', 'x', '\\"', '}{', '],[', ' ']

    def text():
        return "".join(r.choice(bits) for _ in range(r.randrange(12)))

    def value(deep):
        kind = r.randrange(7 if deep < 4 else 4)
        if kind < 2:
            return text()
        if kind < 4:
            return r.choice([None, True, r.randrange(1000), -1.5])
        if kind < 6:
            return {f"k{i}{text()}": value(deep + 1) for i in range(r.randrange(4))}
        return [value(deep + 1) for _ in range(r.randrange(4))]

    return [{"id": i, "v": value(0)} if r.random() < 0.8 else value(1) for i in range(n)]


@pytest.fixture
def small_blocks(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def texts(df):
    return sorted(json.dumps(json.loads(r[0]), sort_keys=True) for r in df.selectExpr("to_json(raw_data)").collect())


@pytest.mark.parametrize("indent", [None, 2])
def test_blocks_cut_anywhere(spark, tmp_path, small_blocks, indent):
    want = []
    for k in range(2):
        values = odd_values(900, k)
        want += values
        (tmp_path / f"f{k}.json").write_text(json.dumps(values, ensure_ascii=bool(k), indent=indent))
    found = read_large_arrays(spark, str(tmp_path))
    assert texts(found) == sorted(json.dumps(v, sort_keys=True) for v in want)


@pytest.mark.parametrize("text, want", [
    ("[]", []), ("  [ ]  ", []), ("[1, \"a}\", [2, {\"b\": 3}], {\"c\": {}}, 4 ]\n", [1, "a}", [2, {"b": 3}], {"c": {}}, 4]), ("[{}]", [{}]), ("[{}, {}]", [{}, {}])])
def test_small_arrays(spark, tmp_path, text, want):
    (tmp_path / "f.json").write_text(text)
    assert texts(read_large_arrays(spark, str(tmp_path))) == sorted(json.dumps(v, sort_keys=True) for v in want)


@pytest.mark.parametrize("text", ["{\"a\": 1}", "[{\"a\": 1}", "[{\"a\": \"1}]", "[{\"a\": 1} {\"b\": 2}]", "[{\"a\": }]", "[{}]]", "[{},]", "[,{}]"])
def test_broken_arrays_fail_by_name(spark, tmp_path, text):
    (tmp_path / "broken.json").write_text(text)
    with pytest.raises(Exception, match="broken.json"):
        read_large_arrays(spark, str(tmp_path)).collect()


def test_sizes_decide(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"id": i, "pad": "x" * 200} for i in range(50)]))
    (tmp_path / "b.json").write_text(json.dumps({"id": 50}))
    found = read_arrays(spark, str(tmp_path), large=1000).selectExpr("variant_get(raw_data, '$.id', 'int') AS id").collect()
    assert sorted(r.id for r in found) == list(range(51))
