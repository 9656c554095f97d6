"""Laws that every load must keep, on small random tables."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import merge as m
from tidemark.operators.dedup import latest_per_key
from tidemark.operators.increment import changed_since, new_mark
from tidemark.operators.snapshot import hash_archive, snapshot_deletes, snapshot_diff, snapshot_diff_by_hash
from tidemark.functions.times import LOOKBACK

SCHEMA = "k long, part string, v double, ins timestamp_ntz, upd timestamp_ntz"
KEYS = ["k", "part"]
STAMP, LATER = "2030-01-01 00:00:00", "2031-01-01 00:00:00"


def table(spark, seed, n=200, keys=40, nulls=True):
    import datetime as dt

    r = random.Random(seed)
    base = dt.datetime(2024, 1, 1)

    def moment():
        return None if r.random() < 0.15 else base + dt.timedelta(minutes=r.randrange(5000))

    rows = [
        (None if nulls and r.random() < 0.1 else r.randrange(keys), r.choice(["a", "b", None] if nulls else ["a", "b"]),
         r.choice([None, 1.0, 2.5, float("nan")]), moment(), moment())
        for _ in range(n)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def unique(df):
    return latest_per_key(df, KEYS, "ins", "upd")


def bag(df):
    return sorted(map(repr, (tuple(r) for r in df.select(sorted(df.columns)).collect())))


def target_of(df):
    return m.with_stamps(unique(df).where("k is not null and part is not null"), "2020-01-01 00:00:00")


@pytest.mark.parametrize("seed", [1, 2])
def test_second_merge_changes_nothing(spark, seed):
    target, latest = target_of(table(spark, seed)), unique(table(spark, seed + 10, nulls=False))
    once = m.next_version(m.merge(target, latest, KEYS, STAMP))
    twice = m.merge(once, latest, KEYS, LATER)
    assert [r["action"] for r in m.action_counts(twice).collect()] == ["keep"]
    assert bag(m.next_version(twice)) == bag(once)


@pytest.mark.parametrize("seed", [3, 4])
def test_strategies_and_hot_split_agree(spark, seed):
    target = target_of(table(spark, seed))
    crowd = target.where("k < 3").withColumn("_c", F.explode(F.sequence(F.lit(1), F.lit(30)))).drop("_c")
    orphans = m.with_stamps(table(spark, seed + 20, n=30).withColumn("part", F.lit(None).cast("string")))
    target = target.unionAll(crowd).unionAll(orphans)
    latest = unique(table(spark, seed + 10))
    hot = m.hot_keys(target, KEYS, share=0.02, floor=0)
    assert hot
    want = bag(m.merge(target, latest, KEYS, STAMP, "shuffle"))
    assert bag(m.merge(target, latest, KEYS, STAMP, "broadcast")) == want
    assert bag(m.merge(target, latest, KEYS, STAMP, "bloom")) == want
    assert bag(m.merge(target, latest, KEYS, STAMP, "bloom", null_keys="rare", hot=hot)) == want
    assert bag(m.merge(target, latest.limit(0), KEYS, STAMP, "bloom")) == bag(m.merge(target, latest.limit(0), KEYS, STAMP, "shuffle"))
    assert bag(m.merge(target, latest, KEYS, STAMP, "shuffle", null_keys="rare")) == want
    assert bag(m.merge(target, latest, KEYS, STAMP, "broadcast", null_keys="rare", hot=hot)) == want
    assert bag(m.merge(target, latest, KEYS, STAMP, "shuffle", hot=hot)) == want
    # a hash that belongs to no hot key, or to a source key only, must not change the result either
    odd = [r[0] for r in latest.where("k is not null and part is not null").select(m.key_hash(KEYS)).limit(5).collect()]
    assert bag(m.merge(target, latest, KEYS, STAMP, "shuffle", hot=hot + odd + [7])) == want


def test_merge_against_plain_python(spark):
    target, latest = target_of(table(spark, 5)), unique(table(spark, 6))
    t = {(r.k, r.part): r for r in target.collect()}
    expected = []
    for r in latest.collect():
        old = t.pop((r.k, r.part), None) if r.k is not None and r.part is not None else None
        row = tuple(r)
        if old is None:
            expected.append((*row, STAMP, "None"))
        elif repr(tuple(old)[:5]) == repr(row):
            expected.append((*row, str(old[5]), "None"))
        else:
            expected.append((*row, str(old[5]), STAMP))
    expected += [(*tuple(r)[:5], str(r[5]), "None") for r in t.values()]
    got = [(*tuple(r)[:5], str(r[5]), str(r[6])) for r in m.next_version(m.merge(target, latest, KEYS, STAMP)).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, expected))


def test_null_keys_are_inserted_anew_unless_rejected(spark):
    latest = unique(table(spark, 7))
    orphans = latest.where("k is null or part is null").count()
    once = m.next_version(m.merge(target_of(table(spark, 8)), latest, KEYS, STAMP))
    again = {r["action"]: r["rows"] for r in m.action_counts(m.merge(once, latest, KEYS, LATER)).collect()}
    assert again["insert"] == orphans > 0
    rejected = {r["action"] for r in m.action_counts(m.merge(once, latest, KEYS, LATER, null_keys="reject")).collect()}
    assert rejected == {"keep"}


def test_increment_and_rest_make_the_whole(spark):
    df = table(spark, 9).where("ins is not null")
    mark = new_mark(df.where("ins < timestamp_ntz'2024-01-03'"), "ins", "upd", insert_only=True).first()["next_mark"] - LOOKBACK
    late = changed_since(df, mark, "ins", "upd")
    rest = df.where(~F.coalesce((F.col("ins") > F.lit(mark)) | (F.col("upd") > F.lit(mark)), F.lit(False)))
    assert bag(late.unionAll(rest)) == bag(df)
    assert changed_since(df, None, "ins", "upd").count() == df.count()


def test_marks_and_order_follow_the_column_type(spark):
    df = spark.sql("""SELECT * FROM VALUES (1, '2024-01-02 10:00:00'), (1, '2024-1-11 09:00:00'), (2, 'soon'), (3, NULL) AS t(k, text)""")
    df = df.selectExpr("k", "text", "try_cast(text AS timestamp_ntz) AS wall", "try_cast(text AS timestamp) AS zoned", "try_cast(text AS date) AS day")
    for name in ("text", "wall", "zoned", "day"):
        assert [r.k for r in changed_since(df, "2024-01-02 10:30:00", name).collect()] == [1], name
        assert changed_since(df, "2024-01-01 23:00:00", name).count() == 2, name
        high = new_mark(df, name, name).first()["next_mark"]
        assert str(high) == ("2024-01-11 00:00:00" if name == "day" else "2024-01-11 09:00:00"), name
        assert latest_per_key(df, ["k"], name).where("k = 1").first()["text"] == "2024-1-11 09:00:00", name


def test_mark_never_moves_back(spark):
    df = table(spark, 10)
    old = "2025-01-01 00:00:00"
    assert str(new_mark(df, "ins", "upd", old=old).first()["next_mark"]) == old
    assert new_mark(df.limit(0), "ins", "upd").first()["next_mark"] is None


def test_snapshot_laws(spark):
    a, b = table(spark, 11, n=60, keys=3), table(spark, 12, n=60, keys=3)
    assert snapshot_diff(a, a).count() == 0
    copies = a.unionAll(a).unionAll(b)
    known = set(map(repr, map(tuple, b.collect())))
    want = sorted(repr(r) for r in map(tuple, copies.collect()) if repr(r) not in known)
    for diff in (snapshot_diff(copies, b), snapshot_diff_by_hash(copies, hash_archive(b))):
        assert sorted(repr(tuple(r)) for r in diff.select(*a.columns).collect()) == want
    gone = snapshot_deletes(a, b, KEYS)
    keys = {(r.k, r.part) for r in a.collect() if r.k is not None and r.part is not None}
    assert gone.count() == sum((r.k, r.part) not in keys for r in b.collect())


def test_snapshot_copies_in_long_runs(spark):
    one = spark.range(1)
    many = spark.range(25_000).select(F.lit(7).cast("long").alias("id"))
    assert snapshot_diff(many, one).count() == 25_000
    assert snapshot_diff(many.unionAll(one), one).select("id").distinct().count() == 1


def test_delete_then_merge_is_a_fresh_insert(spark):
    target = target_of(table(spark, 13))
    latest = unique(table(spark, 13)).where("k is not null and part is not null")
    kept = m.delete_by_feed(target, target, KEYS)
    assert kept.count() == 0
    out = m.merge(kept, latest, KEYS, STAMP)
    assert [r["action"] for r in m.action_counts(out).collect()] == ["insert"]


def test_hot_keys_are_the_frequent_ones(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("id"))
    want = df.where("id = -1").select(m.key_hash(["id"])).first()[0]
    assert m.hot_keys(df, ["id"], floor=100) == [want]
    assert m.hot_keys(df, ["id"]) == []
    assert m.hot_keys(df.limit(0), ["id"], floor=0) == []


def test_delete_with_hot_keys(spark):
    target = m.with_stamps(table(spark, 14, n=300, keys=5), STAMP)
    feed = table(spark, 15, n=6, keys=5)
    hot = m.hot_keys(target, KEYS, floor=0)
    assert hot
    kept, gone = m.delete_by_feed(target, feed, KEYS, hot), m.deleted_rows(target, feed, KEYS, hot)
    assert bag(kept) == bag(m.delete_by_feed(target, feed, KEYS))
    assert bag(kept.unionAll(gone)) == bag(target) and gone.count() > 0


def test_older_batches_do_not_undo(spark):
    row = "1 as k, 'a' as part, {v} as v, timestamp_ntz'{t}' as ins, cast(null as timestamp_ntz) as upd"
    new = spark.sql("select " + row.format(v="2d", t="2024-02-01")).selectExpr("cast(k as long) k", "part", "v", "ins", "upd")
    old = spark.sql("select " + row.format(v="1d", t="2024-01-01")).selectExpr("cast(k as long) k", "part", "v", "ins", "upd")
    target = m.with_stamps(new, STAMP)
    assert m.merge(target, old, KEYS, LATER, newer_by=("ins", "upd")).first()["_action"] == "keep"
    assert m.merge(target, old, KEYS, LATER).first()["_action"] == "update"


def test_key_filter_misses_no_key_and_lets_few_others_pass(spark):
    source = spark.range(0, 40_000, 7).selectExpr("id AS k", "concat('p', id % 3) AS part")
    target = spark.range(40_000).selectExpr("id AS k", "concat('p', id % 3) AS part", "id % 7 = 0 AS wanted")
    marked = m.key_filter(source, KEYS).mark(target, KEYS)
    assert marked.where("wanted AND NOT _maybe").count() == 0
    assert marked.where("NOT wanted AND _maybe").count() < 0.02 * 40_000
    assert m.key_filter(source, KEYS, max_words=1000) is None and m.key_filter(source.limit(0), KEYS) is None
