"""The pipeline's first two stages on clashing column names, null labels, odd rows and empty tables."""

import pytest

import corpus_pipeline as pipeline

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars int, _id string, score double, _text string, features string, x int, raw string, "
          "rawPrediction string, probability string, prediction string, row string, _rk long, _no_id string, _place int, y int, fold int")
EXTRA = ("own id", 7.0, "own text", "f", 1, "r", "rp", "p", "pr", "own row", 5, "no", 3, 9, 8)
CALM = "the {} quiet river runs past old mills and fields of barley near town number {}"
HARSH = "you {} stupid idiot you are worthless trash and i hate you moron number {}"


@pytest.fixture(scope="module")
def place(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("stages"))
    labels = [(i, 1 if i is None or i % 2 else 0, None if i is None or i % 10 == 0 else int(i % 4 == 0)) for i in (*range(160), None, 5000)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def docs_of(spark, pairs):
    return spark.createDataFrame([(i, t, "en", "s", 1, *EXTRA) for i, t in pairs], SCHEMA)


ODD = [(1000, None), (1000, None), (1001, ""), (1002, " \n"), (None, "a text that nobody else has in this table"), (None, None)]


def test_rows_come_through_whole(spark, place):
    pairs = [(i, (HARSH if i % 4 == 0 else CALM).format(f"w{i}", i * 7)) for i in range(160)] + ODD
    docs = docs_of(spark, pairs)
    kept = pipeline.drop_toxic(spark, docs, place)
    assert kept.columns == docs.columns
    rows = [tuple(r) for r in kept.collect()]
    assert all(r[5:] == EXTRA for r in rows) and {(r[0], r[1]) for r in rows} <= set(pairs)
    assert sum(r[0] is not None and r[0] < 160 and r[0] % 4 == 0 for r in rows) < 20 < 100 < sum(r[0] is not None and r[0] % 4 > 0 for r in rows)


def test_one_row_of_each_group_comes_through_whole(spark, place):
    base = " ".join(f"w{i}" for i in range(60))
    pairs = [(9, base), (3, base + " end"), (3, base + " end"), (None, base), (4, base.upper()), *ODD]
    docs = docs_of(spark, pairs)
    kept = pipeline.drop_near_copies(spark, docs, place)
    assert kept.columns == docs.columns
    rows = [tuple(r) for r in kept.collect()]
    assert all(r[5:] == EXTRA for r in rows)
    assert sorted(((r[0], r[1]) for r in rows), key=repr) == sorted([(3, base + " end"), *ODD], key=repr)


def test_empty_tables(spark, place):
    for stage in (pipeline.drop_toxic, pipeline.drop_near_copies):
        out = stage(spark, docs_of(spark, []), place)
        assert out.columns == docs_of(spark, []).columns and out.collect() == []
