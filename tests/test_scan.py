"""Running aggregates over blocks against windows and plain Python, with one group that holds most of the rows."""

import random

from pyspark.sql import Window, functions as F

from tidemark.operators.scan import BLOCK, Blocks

SCHEMA = "g string, at long, v long, k long"


def rows_of(n=3000):
    rng = random.Random(2)
    rows = [("big", rng.randrange(10_000), rng.randrange(100) if rng.random() < 0.7 else None, i) for i in range(n)]
    rows += [(rng.choice(["a", "b", None, "zz"]), None if i % 9 == 0 else i, i % 7 or None, i + n) for i in range(200)]
    return rows


def test_running_aggregates_match_a_window(spark):
    df = spark.createDataFrame(rows_of(), SCHEMA).repartition(5)
    made = {"n": ("sum", F.lit(1)), "s": ("sum", "v"), "hi": ("max", "v"), "lo": ("min", "v"), "x": ("xor", "v"), "seen": ("last", "v")}
    blocks = Blocks(df, ["g"], ["at", "k"], blocks=12)
    got = blocks.running(totals={"all": ("sum", F.lit(1)), "top": ("max", "k")}, **made).rows()
    up = Window.partitionBy("g").orderBy(F.col("at").asc_nulls_first(), "k").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("g")
    want = df.select("*", F.count("*").over(up).alias("n"), F.sum("v").over(up).alias("s"), F.max("v").over(up).alias("hi"), F.min("v").over(up).alias("lo"),
                     F.bit_xor("v").over(up).alias("x"), F.last("v", ignorenulls=True).over(up).alias("seen"), F.count("*").over(whole).alias("all"),
                     F.max("k").over(whole).alias("top"))
    columns = sorted(want.columns)
    assert sorted(map(repr, got.select(columns).collect())) == sorted(map(repr, want.select(columns).collect()))
    assert blocks.df.where("g = 'big'").select(BLOCK).distinct().count() > 8


def test_a_result_can_be_scanned_again(spark):
    df = spark.createDataFrame(rows_of(500), SCHEMA)
    once = Blocks(df, ["g"], ["at", "k"], blocks=6).running(n=("sum", F.lit(1)))
    got = once.running(twice=("sum", "n")).rows().select("g", "n", "twice").collect()
    assert got and all(r.twice == r.n * (r.n + 1) // 2 for r in got)


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert Blocks(empty, ["g"], ["at"]).running(n=("sum", F.lit(1))).rows().collect() == []
