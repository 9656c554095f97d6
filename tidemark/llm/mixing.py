"""Mixing sources to target weights by fitting word budgets as subset sums.

Sources get a share of all words by weight; a source never gives more than ``most`` times its words, what it cannot give is
shared anew by weight. Whole repetitions come first. What remains of a source's budget is fitted exactly: its documents are
counted by length, every length gives the same fraction, and a bounded knapsack over the lengths fills the rest. The
documents of a length are then taken in a seeded order.

Only counts by source and length reach one task, never documents. Places in the seeded order come from counts of hash
buckets, so a length that holds a third of all documents is ranked bucket by bucket.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.common import count_words, staged


def fit_counts(sizes: np.ndarray, counts: np.ndarray, budget: int, window: int, table: int = 1 << 23) -> np.ndarray:
    """How many of the ``counts`` things of each size to take so that sizes add up to ``budget``, or closest below it.

    An equal fraction of every size and then large sizes first leave about ``window``; the knapsack fits that. Where it misses
    the budget, ever more is given back for it to decide, in the end the whole budget, so that no sum comes closer. All is
    measured in the sizes' greatest common divisor. Only if a budget exceeds ``table`` such units, and is missed with that much
    for the knapsack to decide, the best sum found is not known to be the closest.
    """
    sizes, counts = np.asarray(sizes, np.int64), np.asarray(counts, np.int64)
    total, unit = sum(int(s) * int(c) for s, c in zip(sizes, counts)), int(np.gcd.reduce(sizes)) if len(sizes) else 1
    if budget >= total:
        return counts.copy()
    sizes, budget = sizes // unit, budget // unit
    most, free = min(budget, table), 0
    best, missed = _fit(sizes, counts, budget, window, free)
    while missed and free < most:
        free = min(most, max(window, 16 * free))
        take, more = _fit(sizes, counts, budget, window, free)
        if more < missed:
            best, missed = take, more
    return best


def _fit(sizes: np.ndarray, counts: np.ndarray, budget: int, window: int, free: int) -> tuple[np.ndarray, int]:
    """What to take, and what is missed, if the knapsack decides on ``free`` at least, and else on about ``window``."""
    total = sum(int(s) * int(c) for s, c in zip(sizes, counts))
    take = np.array([budget * int(c) // total for c in counts], dtype=np.int64)
    rest = budget - sum(int(s) * int(t) for s, t in zip(sizes, take))
    order = np.argsort(-sizes, kind="stable")
    for i in order[::-1]:
        back = min(int(take[i]), -(-max(0, free - rest) // int(sizes[i])))
        take[i] -= back
        rest += back * int(sizes[i])
    window = max(window, free)
    for i in order:
        more = min(int(counts[i] - take[i]), max(0, rest - window) // int(sizes[i]))
        take[i] += more
        rest -= more * int(sizes[i])
    if rest > 2 * window:  # every size that is left exceeds rest - window: one at most fits, and nothing beside it
        fitting = [i for i in order if take[i] < counts[i] and sizes[i] <= rest]
        if fitting:
            take[fitting[0]] += 1
            rest -= int(sizes[fitting[0]])
        return take, rest
    reached, choice, parts = np.zeros(rest + 1, dtype=bool), np.full(rest + 1, -1, dtype=np.int32), []
    reached[0] = True
    for i in order[::-1]:
        left, step = int(counts[i] - take[i]), 1
        while left and not reached[rest] and int(sizes[i]) <= rest:
            n = min(step, left)
            weight = n * int(sizes[i])
            left, step = left - n, 2 * step
            if weight > rest:
                continue
            new = reached[:-weight] & ~reached[weight:]
            choice[weight:][new] = len(parts)
            reached[weight:] |= new
            parts.append((i, n, weight))
    at = int(np.flatnonzero(reached)[-1])
    missed = rest - at
    while at:
        i, n, weight = parts[choice[at]]
        take[i] += n
        at -= weight
    return take, missed


class Mixture:
    """``docs`` mixed to ``weights``, which repeat over the sources in code point order, a null source last.

    A row's size is its number of words; rows without words are taken zero times. Rows that agree in id, text and source are
    taken alike, as one unit. No document is taken more than ``most`` times. The same input and seed give the same mixture.
    """

    def __init__(self, docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.0, most: int = 3, seed: int = 1,
                 id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", window: int = 1 << 16, buckets: int = 1024):
        self.weights, self.share, self.most, self.seed, self.window, self.buckets = weights, share, most, seed, window, buckets
        self.docs, self.text_col = docs, text_col
        self.key = [F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("rk"), F.col(source_col).cast("string").alias("source")]
        units = docs.select(*self.key, count_words(F.col(text_col)).alias("size")).groupBy("doc_id", "rk", "source", "size")
        self.units = staged(units.agg(F.count("*").alias("m")), "mix-units")

    def targets(self) -> DataFrame:
        """sid, source, source_size, target, base (whole repetitions), rest (words still to fit); one row per source."""
        whole, by_source = Window.partitionBy(), Window.orderBy(F.col("source").asc_nulls_last())
        rows = self.units.groupBy("source").agg(F.sum(F.col("m") * F.col("size")).alias("source_size"))
        weight = F.element_at(F.array(*map(F.lit, self.weights)), F.pmod(F.col("sid"), F.lit(len(self.weights))) + 1)
        rows = rows.withColumn("sid", F.row_number().over(by_source) - 1).withColumn("weight", weight).withColumn("cap", self.most * F.col("source_size"))
        # Sources that fill up first come first; those before a source give all they can, the others share by weight.
        filling = Window.orderBy(F.col("cap") / F.col("weight"), "sid")
        rows = rows.withColumn("all", F.sum("source_size").over(whole) * F.lit(self.share))
        rows = rows.withColumn("left", F.col("all") - (F.sum("cap").over(filling) - F.col("cap")))
        rows = rows.withColumn("weights", F.sum("weight").over(whole) - F.sum("weight").over(filling) + F.col("weight"))
        rows = rows.withColumn("free", F.col("left") * F.col("weight") < F.col("cap") * F.col("weights"))
        level = F.min(F.when(F.col("free"), F.struct((F.col("cap") / F.col("weight")).alias("at"), "sid", (F.col("left") / F.col("weights")).alias("level")))).over(whole)
        target = F.when(F.col("free"), level["level"] * F.col("weight")).otherwise(F.col("cap").cast("double"))
        rows = rows.withColumn("target", target)
        base = F.when(F.col("source_size") > 0, F.floor(F.round("target") / F.col("source_size"))).otherwise(0).cast("long")
        rows = rows.withColumn("base", F.least(base, F.lit(self.most)))
        rest = F.when(F.col("base") < self.most, F.round("target").cast("long") - F.col("base") * F.col("source_size")).otherwise(0)
        return staged(rows.select("sid", "source", "source_size", "target", "base", F.greatest(rest, F.lit(0)).cast("long").alias("rest")), "mix-targets")

    def taken(self) -> DataFrame:
        """doc_id, rk, source, size, m, source_size, target, copies; one row per unit."""
        targets = self.targets()
        units = self.units.join(targets, self.units.source.eqNullSafe(targets.source)).drop(targets.source)
        units = units.withColumn("length", F.col("m") * F.col("size"))
        lengths = units.where("length > 0 and rest > 0").groupBy("sid", "length", "rest").agg(F.count("*").alias("n"))
        window = self.window

        def fit(rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values("length", kind="stable")
            rows["extra"] = fit_counts(rows.length.to_numpy(np.int64), rows.n.to_numpy(np.int64), int(rows.rest.iloc[0]), window)
            return rows[["sid", "length", "extra"]]

        extra = staged(lengths.groupBy("sid").applyInPandas(fit, "sid int, length long, extra long"), "mix-extra")
        turn = F.xxhash64(F.lit(self.seed), "doc_id", "rk")
        units = units.withColumn("turn", turn).withColumn("bucket", F.pmod(turn, F.lit(self.buckets)))
        cell = ["sid", "length", "bucket"]
        cells = units.where("length > 0").groupBy(*cell).agg(F.count("*").alias("here"))
        below = F.sum("here").over(Window.partitionBy("sid", "length").orderBy("bucket")) - F.col("here")
        quota = cells.select(*cell, below.alias("below")).join(extra, ["sid", "length"]).select(*cell, (F.col("extra") - F.col("below")).alias("quota"))
        place = F.row_number().over(Window.partitionBy(*cell).orderBy("turn", "doc_id", "rk"))
        chosen = units.join(quota, cell, "left").withColumn("copies", F.when(
            F.col("length") > 0, F.col("base") + (place <= F.coalesce("quota", F.lit(0))).cast("long")).otherwise(F.lit(0).cast("long")))
        return chosen.select("doc_id", "rk", "source", "size", "m", "source_size", "target", "copies")

    def documents(self) -> DataFrame:
        """The mixture itself: each row of ``docs`` as often as it is taken, with all its columns."""
        taken = self.taken().where("copies > 0").select(*(F.col(c).alias(f"t_{c}") for c in ("doc_id", "rk", "source")), "copies")
        rows = self.docs.select(F.struct("*").alias("row"), *self.key)
        same = F.col("doc_id").eqNullSafe(F.col("t_doc_id")) & (F.col("rk") == F.col("t_rk")) & F.col("source").eqNullSafe(F.col("t_source"))
        rows = rows.join(taken.hint("shuffle_hash"), same)
        return rows.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target (of the row's source), taken (words, repeats counted); one row per row of ``docs``."""
    rows = Mixture(docs, **options).taken()
    rows = rows.select("*", F.explode(F.sequence(F.lit(1), F.col("m").cast("int"))))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
