"""Toxicity scores: gradient-boosted trees over dense text features, calibrated by isotonic regression.

Features of a text: density of insults, of insults in disguise (digits and signs for letters, stretched letters), of words
and of word beginnings that labelled toxic texts use far more often than clean ones, share of those hits near an address
in the second person, largest number of hits within a window, capitals, shouted words, exclamation and other marks,
characters in place of letters, length.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import staged

# Insults and second-person words, each list in its languages' own spelling.
INSULTS = ("idiot moron stupid dumb loser pathetic worthless disgusting trash scum clown fool jerk liar ugly coward "
           "dumm trottel versager idiota tonto imbécil basura imbécile crétin nul ordure").split()
SECOND_PERSON = "you your yours yourself u ur du dich dir dein ihr euch tu te toi vous votre tes usted ustedes tus vosotros".split()
MARKS = ".,;:!?\"'()[]{}<>|*&%$#@~_-+=/\\…¡¿«»“”„"
DISGUISE = str.maketrans("013457@$!|", "oieastasii")
WIDTH = 12
THRESHOLD = 0.3
_RUN = re.compile(r"(.)\1{2,}")


def _plain(word: str) -> str:
    """The word behind digits, signs and stretched letters."""
    return _RUN.sub(r"\1", word.translate(DISGUISE)).replace("*", "").replace(".", "").replace("-", "")


def _features(words_learned: frozenset, starts_learned: frozenset):
    insults, second = frozenset(INSULTS), frozenset(SECOND_PERSON)

    def of(text: str) -> list[float]:
        words = text.lower().split()
        n, length = len(words), len(text)
        if not n:
            return [0.0] * WIDTH
        open_, hidden, learned, starts, hits = 0, 0, 0, 0, []
        for i, raw in enumerate(words):
            word = raw.strip(MARKS)
            if word in insults:
                open_ += 1
                hits.append(i)
            elif not word.isalpha() and len(word) > 2 and _plain(word) in insults:
                hidden += 1
                hits.append(i)
            if word in words_learned:
                learned += 1
                if not hits or hits[-1] != i:
                    hits.append(i)
            if word[:4] in starts_learned or word[:5] in starts_learned:
                starts += 1
                if not hits or hits[-1] != i:
                    hits.append(i)
        near = sum(not second.isdisjoint(words[max(0, i - 5) : i + 6]) for i in hits)
        crowd = first = 0
        for last, i in enumerate(hits):
            while i - hits[first] > 20:
                first += 1
            crowd = max(crowd, last - first + 1)
        letters = sum(map(str.isalpha, text)) or 1
        capitals = sum(map(str.isupper, text))
        per = 100.0 / n
        return [
            open_ * per, hidden * per, learned * per, starts * per, float(min(len(hits), 20)), float(crowd), near / max(1, len(hits)),
            capitals / letters, sum(w.isupper() and len(w) > 2 for w in text.split()) * per, text.count("!") / length,
            sum(map(text.count, "*$@#%&|")) / length, float(np.log1p(n)),
        ]

    def run(batches):
        for batch in batches:
            rows = [of(x or "") for x in batch.column("text").to_pylist()]
            flat = np.array(rows, dtype=np.float64).ravel()
            column = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * WIDTH), pa.array(flat))
            keep = [x for x in batch.schema.names if x != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in keep), column], names=[*keep, "features"])

    return run


class ToxicityModel:
    """Fitted on ``labels`` of those documents that ``train`` (a condition on the id) admits.

    ``sample`` bounds the labelled rows that are used: those with the smallest seeded hash of the id. Learned words and word
    beginnings come from all of them; a row that trains the trees or the calibration has features from the other folds'
    words only. Ids, languages and sources are never features. Several labels of one id count as toxic if one does; null
    labels and ids count for nothing. Without both classes the score is the share of toxic labels (0 without labels).
    """

    def __init__(self, docs: DataFrame, labels: DataFrame, train=None, sample: int = 20_000, trees: int = 30, depth: int = 3,
                 folds: int = 3, words: int = 3_000):
        doc_id = F.col("doc_id").cast("long")
        labels = labels.select(doc_id.alias("doc_id"), F.col("toxic").cast("int").alias("y")).where("doc_id is not null and y is not null")
        labels = labels.where(train if train is not None else F.lit(True)).groupBy("doc_id").agg(F.max("y").alias("y"))
        turn = F.xxhash64("doc_id", F.lit("toxicity"))
        chosen = labels.orderBy(turn, "doc_id").limit(sample)
        chosen = chosen.select("doc_id", "y", F.pmod(turn, F.lit(folds)).alias("fold"), (F.pmod(turn, F.lit(4 * folds)) < folds).alias("late"))
        rows = docs.select(doc_id.alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
        rows = staged(rows.select("y", "fold", "late", F.coalesce("text", F.lit("")).alias("text")), "toxic-rows")
        kinds = {(r["fold"], r["y"], r["late"]): r["count"] for r in rows.groupBy("fold", "y", "late").count().collect()}
        toxic = sum(n for (_, y, _), n in kinds.items() if y)
        self.share, self.trees, self.curve = toxic / max(1, sum(kinds.values())), None, None
        counts = self._counts(rows, folds)
        self.lexicon = self._lexicon(counts, kinds, range(folds), words)
        early, late = ({y for _, y, x in kinds if x == part} for part in (False, True))
        if early != {0, 1}:
            return
        parts = [self.featured(rows.where(F.col("fold") == f), self._lexicon(counts, kinds, [g for g in range(folds) if g != f], words))
                 for f in range(folds)]
        held = parts[0]
        for part in parts[1:]:
            held = held.union(part)
        held = staged(held, "toxic-features").withColumn("x", array_to_vector("features"))
        self.trees = GBTClassifier(featuresCol="x", labelCol="y", maxIter=trees, maxDepth=depth, stepSize=0.2, minInstancesPerNode=3,
                                   checkpointInterval=-1, seed=7).fit(held.where("not late").coalesce(2))
        if late == {0, 1}:
            rows = self._raw(held.where("late")).select("raw", F.col("y").cast("double").alias("y"))
            self.curve = IsotonicRegression(featuresCol="raw", labelCol="y", predictionCol="score").fit(rows.coalesce(1))

    @staticmethod
    def _counts(rows: DataFrame, folds: int) -> DataFrame:
        """Documents per term, class and fold; terms are words and word beginnings of four and five letters."""
        words = F.array_distinct(F.transform(F.split(F.lower("text"), r"\s+"), lambda w: F.btrim(w, F.lit(MARKS))))
        words = F.filter(words, lambda w: F.length(w) >= 3)
        starts = F.array_distinct(F.flatten(F.transform(words, lambda w: F.array(F.substring(w, 1, 4), F.substring(w, 1, 5)))))
        terms = F.concat(F.transform(words, lambda w: F.concat(F.lit("="), w)), F.transform(
            F.filter(starts, lambda w: F.length(w) >= 4), lambda w: F.concat(F.lit("^"), w)))
        seen = rows.select("y", "fold", F.explode(terms).alias("term")).groupBy("term").agg(*(
            F.sum(F.expr(f"int(fold = {f} and y = {y})")).alias(f"{name}{f}") for f in range(folds) for y, name in ((1, "t"), (0, "c"))))
        return staged(seen.where(" + ".join(f"t{f}" for f in range(folds)) + " >= 2"), "toxic-terms")

    @staticmethod
    def _lexicon(counts: DataFrame, kinds: dict, folds, most: int) -> tuple[frozenset, frozenset]:
        """Words and word beginnings of toxic texts by smoothed log odds over the given folds; at most ``most`` each."""
        total = {y: sum(n for (f, k, _), n in kinds.items() if k == y and f in folds) for y in (0, 1)}
        found = []
        for mark, least in (("=", 4), ("^", 4)):
            t, c = (F.expr(" + ".join(f"{name}{f}" for f in folds)) for name in "tc")
            odds = F.log((t + 0.5) / (total[1] + 1)) - F.log((c + 0.5) / (total[0] + 1))
            best = (counts.where(F.col("term").startswith(mark)).where(t >= least).withColumn("odds", odds).where("odds >= 2.5")
                    .orderBy(F.desc("odds"), F.desc(t), "term").limit(most).select("term"))
            found.append(frozenset(r["term"][1:] for r in best.collect()))
        return found[0], found[1]

    def featured(self, rows: DataFrame, lexicon: tuple[frozenset, frozenset] | None = None) -> DataFrame:
        kinds = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes if c != "text")
        return rows.mapInArrow(_features(*(lexicon or self.lexicon)), f"{kinds}, features array<double>")

    def _raw(self, rows: DataFrame) -> DataFrame:
        return self.trees.transform(rows).withColumn("raw", vector_to_array("probability")[1])

    def score(self, rows: DataFrame) -> DataFrame:
        """``rows`` (any columns, one called text, which may be null) with a score from 0 to 1 instead of the text."""
        keep = [c for c in rows.columns if c != "text"]
        out = self.featured(rows).withColumn("x", array_to_vector("features"))
        if self.trees is None:
            return out.select(*keep, F.lit(float(self.share)).alias("score"))
        out = self._raw(out)
        if self.curve is None:
            return out.select(*keep, F.col("raw").alias("score"))
        # A little of the raw score keeps the order within the steps of the calibration curve.
        score = F.least(F.lit(1.0), F.greatest(F.lit(0.0), 0.98 * F.col("score") + 0.02 * F.col("raw")))
        return self.curve.transform(out).select(*keep, score.alias("score"))


def score_documents(docs: DataFrame, labels: DataFrame, train=None, threshold: float = THRESHOLD, **options) -> DataFrame:
    """doc_id, score, predicted (1 from ``threshold`` on) for every row of ``docs``; null texts are empty."""
    model = ToxicityModel(docs, labels, train, **options)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return model.score(rows).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
