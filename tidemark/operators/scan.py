"""Numbering and running aggregates in order within groups, when one group may hold most of the rows.

A window over a group runs in one task. Here rows are dealt to ranges of (group, order) first, so that a large group spans
several blocks of even size. Each block is worked on alone; what a block needs of the blocks before it is one row per
block, because only the group at a block's beginning can have begun earlier.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.sinks.storage import scratch_path

BLOCK = "_block"


def _first_known(a: Column, b: Column) -> Column:
    return F.coalesce(b, a)


def _both(combine):
    """``combine`` of two values; where one is null, the other."""
    return lambda a, b: F.coalesce(combine(a, b), a, b)


#: kind: (aggregate of the rows of a block, that of earlier blocks with that of this one)
KINDS = {
    "sum": (F.sum, _both(lambda a, b: a + b)),
    "max": (F.max, _both(F.greatest)),
    "min": (F.min, _both(F.least)),
    "xor": (F.bit_xor, _both(lambda a, b: a.bitwiseXOR(b))),
    "last": (lambda c: F.last(c, ignorenulls=True), _first_known),
}


class Blocks:
    """``df`` in blocks of consecutive rows of (group, order), written once below the shared folder.

    Ascending order, nulls first, null groups being a group of their own. Rows equal in ``group`` and ``order`` lie in one
    block and may change places among each other. ``running`` can be used again on its own result.
    """

    def __init__(self, df: DataFrame, group: list[str], order: list[str], blocks: int | None = None, label: str = "blocks"):
        spark = df.sparkSession
        self.group, self.order = list(group), list(order)
        by = [F.col(c).asc_nulls_first() for c in (*group, *order)]
        n = blocks or int(spark.conf.get("spark.sql.shuffle.partitions"))
        path = scratch_path(spark, label)
        df.repartitionByRange(n, *by).withColumn(BLOCK, F.spark_partition_id()).write.parquet(path)
        self.df = spark.read.parquet(path)

    def _with(self, df: DataFrame) -> Blocks:
        out = object.__new__(Blocks)
        out.group, out.order, out.df = self.group, self.order, df
        return out

    def _spanning(self) -> DataFrame:
        """Groups that lie in several blocks: at most one for each two blocks that touch."""
        key = F.struct(*[F.col(c) for c in self.group])
        ends = self.df.groupBy(BLOCK).agg(F.min(key).alias("lo"), F.max(key).alias("hi"))
        return (ends.select(BLOCK, F.explode(F.array("lo", "hi")).alias("g")).distinct()
                .groupBy("g").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("g.*"))

    def _same(self, left: DataFrame, right: DataFrame, names) -> Column:
        return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[f"_r_{c}"]) for c in names])

    def _of_block(self, kind: str, c) -> Column:
        if kind != "last":
            return KINDS[kind][0](c)
        c = F.col(c) if isinstance(c, str) else c
        return F.max_by(c, F.when(c.isNotNull(), F.struct(*[F.col(o) for o in self.order])))

    def running(self, totals: dict | None = None, **made) -> Blocks:
        """With a column for each of ``made``, name = (kind, column): the aggregate over the group's rows up to this one.

        ``totals`` is alike, over all rows of the group; ``last`` needs an order and is for running aggregates alone.
        """
        totals = totals or {}
        asked = {**made, **totals}
        spanning = self._spanning()
        marked = spanning.select(*[F.col(c).alias(f"_r_{c}") for c in self.group])
        inside = self.df.join(F.broadcast(marked), self._same(self.df, marked, self.group), "left_semi")
        sums = inside.groupBy(*self.group, BLOCK).agg(*[self._of_block(kind, c).alias(f"_s_{name}") for name, (kind, c) in asked.items()])
        every, before = Window.partitionBy(*self.group), Window.partitionBy(*self.group).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
        carry = sums.select(
            *[F.col(c).alias(f"_r_{c}") for c in (*self.group, BLOCK)],
            *[KINDS[kind][0](f"_s_{name}").over(before).alias(f"_c_{name}") for name, (kind, _) in made.items()],
            *[KINDS[kind][0](f"_s_{name}").over(every).alias(f"_c_{name}") for name, (kind, _) in totals.items()])
        here = Window.partitionBy(*self.group, BLOCK)
        up_to = here.orderBy(*[F.col(c).asc_nulls_first() for c in self.order]).rowsBetween(Window.unboundedPreceding, 0)
        local = self.df.select(
            "*", *[KINDS[kind][0](c).over(up_to).alias(f"_l_{name}") for name, (kind, c) in made.items()],
            *[KINDS[kind][0](c).over(here).alias(f"_l_{name}") for name, (kind, c) in totals.items()])
        # at most two rows per block are broadcast
        joined = local.join(F.broadcast(carry), self._same(local, carry, (*self.group, BLOCK)), "left")
        return self._with(joined.select(
            *self.df.columns, *[KINDS[kind][1](F.col(f"_c_{name}"), F.col(f"_l_{name}")).alias(name) for name, (kind, _) in made.items()],
            *[F.coalesce(f"_c_{name}", f"_l_{name}").alias(name) for name in totals]))

    def rows(self) -> DataFrame:
        return self.df.drop(BLOCK)
