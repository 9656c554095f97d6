"""Snapshots with digests: the difference is exact and reads only leaves that changed."""

import contextlib
import io
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.snapshot import snapshot_diff
from tidemark.sinks.archive import SnapshotArchive

SCHEMA = "k long, v string, x double, m map<string,int>"


def rows_of(seed, n=400):
    r = random.Random(seed)
    return [(r.randrange(200) if r.random() < 0.9 else None, r.choice(["a", "b", None, ""]), r.choice([0.0, -1.5, float("nan"), None]),
             r.choice([None, {"p": 1}, {"q": 2, "p": 1}])) for _ in range(n)]


def bag(df):
    return sorted(map(repr, df.collect()))


def both(spark, tmp_path, old, new, **options):
    archive = SnapshotArchive(spark, str(tmp_path / "snap"), marker="_MERGED", **options)
    before = archive.write(old)
    archive.commit(before)
    return archive, archive.write(new), before


@pytest.mark.parametrize("leaves", [1, 16])
def test_difference_is_exact(spark, tmp_path, leaves):
    old, new = spark.createDataFrame(rows_of(1), SCHEMA), spark.createDataFrame(rows_of(2), SCHEMA)
    archive, now, before = both(spark, tmp_path, old, new, leaves=leaves)
    assert bag(archive.read(now)) == bag(new) and archive.current() == before
    assert bag(archive.diff(now, before)) == bag(snapshot_diff(new, old)) != []


def test_an_unchanged_table_reads_no_archived_rows(spark, tmp_path):
    crowd = [(1, "same", 1.0, None)] * 3000
    old = spark.createDataFrame(rows_of(3) + crowd, SCHEMA)
    archive, now, before = both(spark, tmp_path, old, old.repartition(5).orderBy("v"))
    assert archive.changed_leaves(now, before) == []
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        archive.diff(now, before).explain()
    assert "FileScan" not in out.getvalue() and archive.diff(now, before).collect() == []


def test_one_changed_row_reads_two_leaves(spark, tmp_path):
    old = spark.range(5000).selectExpr("id AS k", "concat('v', id) AS v")
    new = old.withColumn("v", F.when(F.col("k") == 77, "other").otherwise(F.col("v")))
    archive, now, before = both(spark, tmp_path, old, new)
    assert 1 <= len(archive.changed_leaves(now, before)) <= 2
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        archive.diff(now, before).explain("formatted")
    assert "PartitionFilters: [isnotnull(_leaf" in out.getvalue() or "PartitionFilters: [_leaf" in out.getvalue()
    assert [tuple(r) for r in archive.diff(now, before).collect()] == [(77, "other")]


def test_one_copy_more_is_a_difference(spark, tmp_path):
    old = spark.createDataFrame([(1, "a", 1.0, None)] * 2, SCHEMA)
    new = spark.createDataFrame([(1, "a", 1.0, None)] * 3, SCHEMA)
    archive, now, before = both(spark, tmp_path, old, new)
    assert len(archive.changed_leaves(now, before)) == 1 and archive.diff(now, before).collect() == []  # known row, as in snapshot_diff


def test_empty_and_unlike_versions(spark, tmp_path):
    none, some = spark.createDataFrame([], SCHEMA), spark.createDataFrame(rows_of(4, 20), SCHEMA)
    archive, now, before = both(spark, tmp_path, none, some)
    assert bag(archive.diff(now, before)) == bag(some) and archive.diff(before, now).collect() == []
    archive.commit(now)
    archive.leaves = 7
    other = archive.write(some)
    assert archive.changed_leaves(other, now) is None and archive.diff(other, now).collect() == []
