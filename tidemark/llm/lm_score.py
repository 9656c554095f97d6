"""Text scores of a log-bilinear language model trained by noise-contrastive estimation.

Words are counted over all training texts. The most frequent ones and the end of a text are outcomes of their own; every other
word falls into one of a few classes by its last bytes, and within its class it has its smoothed share of the class's count.
The model predicts an outcome from the two before it: context vectors pass through one matrix per position, their sum meets
the outcome's vector, and a bias is added.

Texts are written once as outcome numbers, which training and scoring read. Training goes through all training texts once, in
rounds: in each round every task walks over its own texts from the same start, by minibatches against noise from the outcome
frequencies, and the parameters are averaged by tokens. Logarithms of the normalising sums come from matrix products over all
contexts. Counts of words beyond a bounded table of frequent ones are looked up by a join, so that the vocabulary may be of
any size.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.common import staged

START_NOISE = 1e-3
PIECE = 4 << 20  # bytes that are worked on at a time
OUTCOME = np.uint16
ENCODED = ["doc_id", "train", "place", "n_tokens", "n_known", "logs", "plain", "rare", "times", "ids"]


def _class_of(word: bytes, classes: int) -> int:
    return zlib.crc32(word[-2:]) % classes


def _pieces(batch, column: str, most: int):
    """A batch's rows in pieces of about ``most`` bytes of one column, so that memory does not grow with the batch."""
    size = pc.binary_length(batch.column(column).fill_null(b"" if pa.types.is_binary(batch.column(column).type) else ""))
    piece = np.cumsum(size.to_numpy(zero_copy_only=False).astype(np.int64)) // most
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(piece)) + 1, [len(piece)]])
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if b > a:
            yield batch.slice(a, b - a)


def _words(texts) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The different words of consecutive texts, each word's place among them, and its text's place."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    own = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    coded = lists.flatten().dictionary_encode()
    places, words = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
    none = pc.index(words, "").as_py()
    if none >= 0:  # what stands before a leading gap, or after a last one
        some = places != none
        places, own = places[some], own[some]
    return words, places, own


def _count(batches):
    """Partial counts of words, and of ends under the empty word; at most some hundred thousand words are held at a time."""
    counts: dict[bytes, int] = {}

    def flush():
        out = pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.binary()).cast(pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])
        counts.clear()
        return out

    for batch in batches:
        for piece in _pieces(batch, "text", PIECE):
            words, places, _ = _words(piece.column("text"))
            found = np.bincount(places, minlength=len(words))
            for word, n in zip(words.cast(pa.binary()).to_pylist(), found.tolist()):
                if n:
                    counts[word] = counts.get(word, 0) + n
            counts[b""] = counts.get(b"", 0) + piece.num_rows
            if len(counts) > 300_000:
                yield flush()
    yield flush()


class _Parameters:
    """Vectors r (outcomes x d), matrices c1 and c2 (d x d) and biases b, flattened in this order for transport."""

    def __init__(self, outcomes: int, d: int, flat: np.ndarray | None = None, kind=np.float64):
        cuts = np.cumsum([outcomes * d, d * d, d * d, outcomes])
        self.flat = np.zeros(cuts[-1], kind) if flat is None else np.array(flat, dtype=kind)
        r, c1, c2, b = np.split(self.flat, cuts[:-1])
        self.r, self.c1, self.c2, self.b = r.reshape(outcomes, d), c1.reshape(d, d), c2.reshape(d, d), b


def _begin(log_share: np.ndarray, d: int, seed: int) -> np.ndarray:
    p = _Parameters(len(log_share), d)
    p.r[:] = np.random.default_rng(seed).normal(0, 0.3, p.r.shape)
    p.c1[:], p.c2[:] = np.eye(d) * 0.3, np.eye(d) * 0.3
    p.b[:] = log_share
    return p.flat


def _encode(shared):
    """Each text as the outcomes of its words and its end, with sums over its words in the table and a list of the others."""
    words, outcome_of, log_of, first, classes, known_end, end_log = shared.value
    numbers = {w: i for i, w in enumerate(words)}

    def run(batches):
        for batch in batches:
            for piece in _pieces(batch, "text", PIECE):
                yield encoded(piece)

    def encoded(piece):
        found, places, own = _words(piece.column("text"))
        texts, names = piece.num_rows, found.cast(pa.binary()).to_pylist()
        number = np.fromiter((numbers.get(w, -1) for w in names), np.int64, len(names))
        known = number >= 0
        outcome, log = np.zeros(len(names), OUTCOME), np.zeros(len(names))
        outcome[known], log[known] = outcome_of[number[known]], log_of[number[known]]
        for i in np.flatnonzero(~known).tolist():
            outcome[i] = first + _class_of(names[i], classes)
        sizes = np.bincount(own, minlength=texts)
        ids = np.zeros(len(places) + texts, OUTCOME)  # 0 is the end of a text
        ids[np.arange(len(places)) + own] = outcome[places]
        cuts = np.concatenate([[0], np.cumsum(sizes + 1)])
        per_text = [np.bincount(own, x[places], texts) for x in (known.astype(float), log, np.where(outcome >= first, log, 0.0))]
        other = ~known[places]
        pairs, times = np.unique(own[other] * np.int64(max(1, len(names))) + places[other], return_counts=True)
        of, word = np.divmod(pairs, max(1, len(names)))
        lists = pa.array(np.searchsorted(of, np.arange(texts + 1)), pa.int32())
        return pa.RecordBatch.from_arrays([
            *(piece.column(c) for c in ("doc_id", "train", "place")), pa.array(sizes + 1, pa.int64()), pa.array(per_text[0].astype(np.int64) + known_end),
            pa.array(per_text[1] + end_log), pa.array(per_text[2]), pa.ListArray.from_arrays(lists, found.take(pa.array(word))),
            pa.ListArray.from_arrays(lists, pa.array(times, pa.int64())), _binary(ids, cuts)], names=ENCODED)

    return run


def _binary(ids: np.ndarray, cuts: np.ndarray) -> pa.Array:
    offsets = (cuts * ids.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(ids.tobytes())])


def _tokens(column) -> tuple[np.ndarray, np.ndarray]:
    """Outcomes of consecutive encoded texts, each with its end, and the place after each end."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    ids = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]].view(OUTCOME)
    return ids.astype(np.int32), (offsets[1:].astype(np.int64) - offsets[0]) // np.dtype(OUTCOME).itemsize


def _contexts(ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The last and the last but one outcome before each; before a text stand ends."""
    one, two = np.roll(ids, 1), np.roll(ids, 2)
    begins = np.concatenate([[0], ends[:-1]])
    one[begins], two[begins] = 0, 0
    after = begins + 1
    after = after[after < np.append(ends, len(ids))[: len(after)]]
    two[after] = 0
    return one, two


def train_batches(p: _Parameters, ids, one, two, log_noise: np.ndarray, rng, squares: _Parameters, batch: int = 2048, noise: int = 48,
                  rate: float = 0.08) -> None:
    """One walk over the tokens: noise-contrastive steps with noise words shared by a minibatch and per-parameter step sizes."""
    k, d = p.r.shape
    kind = p.flat.dtype
    reach = np.cumsum(np.exp(log_noise))
    less = (log_noise + math.log(noise)).astype(kind)
    g, lanes = _Parameters(k, d, np.zeros_like(p.flat), kind), np.arange(d)
    for a in range(0, len(ids), batch):
        w, x, y = ids[a : a + batch], one[a : a + batch], two[a : a + batch]
        v = np.minimum(np.searchsorted(reach, rng.random(noise) * reach[-1], side="right"), k - 1)
        rx, ry, rw, rv = p.r[x], p.r[y], p.r[w], p.r[v]
        q = rx @ p.c1 + ry @ p.c2
        own = np.einsum("ij,ij->i", q, rw) + (p.b - less)[w]
        other = q @ rv.T + (p.b - less)[v]
        scale = kind.type(1 / len(w))
        up = scale / (1 + np.exp(np.clip(own, -30, 30)))  # towards the word
        down = -scale / (1 + np.exp(-np.clip(other, -30, 30)))  # away from noise
        dq = up[:, None] * rw + down @ rv
        at = np.concatenate([w, x, y, v])
        rows = np.concatenate([up[:, None] * q, dq @ p.c1.T, dq @ p.c2.T, down.T @ q])
        g.r[:] = np.bincount((at[:, None] * d + lanes).ravel(), rows.ravel(), k * d).reshape(k, d)
        g.c1[:], g.c2[:] = rx.T @ dq, ry.T @ dq
        g.b[:] = np.bincount(w, up, k)
        np.add.at(g.b, v, down.sum(axis=0))
        squares.flat += g.flat**2
        p.flat += kind.type(rate) * g.flat / (np.sqrt(squares.flat) + kind.type(1e-6))


def _walk(log_noise, start, d, seed):
    def run(batches):
        k, kind = len(log_noise), np.dtype(np.float32)
        p, squares = _Parameters(k, d, start, kind), _Parameters(k, d, np.full(len(start), START_NOISE**2), kind)
        rng, seen = np.random.default_rng(seed), 0
        for batch in batches:
            for piece in _pieces(batch, "ids", PIECE):
                ids, ends = _tokens(piece.column("ids"))
                train_batches(p, ids, *_contexts(ids, ends), log_noise, rng, squares)
                seen += len(ids)
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([seen], pa.int64()), pa.array([p.flat.tolist()], pa.list_(pa.float64()))], names=["seen", "flat"])

    return run


class LanguageModel:
    """``train`` is a condition on the id that says which documents to learn from; a null id counts as not admitted.

    Every row counts and is scored by itself, repeated rows too; null and empty texts have an end only. Other columns are not read.
    """

    def __init__(self, docs: DataFrame, train, listed: int = 1023, classes: int = 384, d: int = 24, table: int = 200_000,
                 rounds: tuple[float, ...] = (0.1, 0.3, 1.0), seed: int = 11):
        self.spark, self.classes, self.d, self.table = docs.sparkSession, classes, d, table
        self.docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        self.train = F.coalesce(train, F.lit(False))
        learn = self.docs.where(self.train)
        self.counts = staged(learn.select("text").mapInArrow(_count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")), "lm-counts")
        totals = self.counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
        self.n, self.v = totals["n"] or 0, totals["v"]
        self.frequent = self._frequent(table)
        top = self.counts.where("word <> ''").orderBy(F.desc("n"), "word").limit(listed).collect()
        self.frequent.update({r["word"].encode(): int(r["n"]) for r in top})
        self.listed = [r["word"].encode() for r in top]
        self.ends = self.frequent.get(b"", 0) or (self.counts.where("word = ''").agg(F.sum("n")).first()[0] or 0)
        self._shares()
        self.encoded = self._encoded(seed)
        self.flat = self._fit(rounds, seed) if self.n else None

    def _frequent(self, most: int) -> dict[bytes, int]:
        """Words above the smallest count that at most ``most`` words reach, so that only those come to the driver."""
        same = self.counts.groupBy("n").agg(F.count("*").alias("words"))
        reach = F.sum("words").over(Window.orderBy(F.desc("n")))
        least = same.select("n", reach.alias("reach")).where(F.col("reach") <= most).agg(F.min("n")).first()[0]
        if least is None:
            return {}
        found = self.counts.where(F.col("n") >= least).toPandas()
        return {w.encode(): int(n) for w, n in zip(found.word, found.n)}

    def _shares(self) -> None:
        """Logarithms of the smoothed outcome frequencies, and per class what its words and one unseen word share."""
        listed = self.spark.createDataFrame([(w.decode(),) for w in self.listed] + [("",)], "word string")
        last = F.substring(F.col("word").cast("binary"), -2, 2)
        rest = self.counts.join(F.broadcast(listed), "word", "left_anti").groupBy(F.pmod(F.crc32(last), F.lit(self.classes)).alias("c"))
        self.shared = np.ones(self.classes)
        mass = np.ones(self.classes)
        for r in rest.agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():
            self.shared[r["c"]] += r["n"] + r["v"]
            mass[r["c"]] += r["n"]
        counts = np.concatenate([[self.ends + 1], [self.frequent[w] + 1 for w in self.listed], mass]).astype(float)
        self.log_share = np.log(counts / counts.sum())

    def _encoded(self, seed: int) -> DataFrame:
        """All documents with their words as outcomes, written once: training and scoring read these, not the texts."""
        words = list(self.frequent)
        own = {w: i + 1 for i, w in enumerate(self.listed)}
        first = len(self.listed) + 1
        if first + self.classes > np.iinfo(OUTCOME).max:
            raise ValueError(f"more than {np.iinfo(OUTCOME).max} outcomes")
        outcome_of = np.array([own.get(w) or first + _class_of(w, self.classes) for w in words], OUTCOME)
        log_of = np.log10(np.array([self.frequent[w] + 1 for w in words], float))
        shared = self.spark.sparkContext.broadcast((words, outcome_of, log_of, first, self.classes, int(self.ends > 0), math.log10(self.ends + 1)))
        place = F.pmod(F.xxhash64("text", F.lit(seed)), F.lit(1000)) / 1000
        rows = self.docs.select("doc_id", self.train.alias("train"), place.alias("place"), "text")
        kinds = ("doc_id long, train boolean, place double, n_tokens long, n_known long, logs double, plain double, rare array<string>, "
                 "times array<long>, ids binary")
        coded = rows.mapInArrow(lambda batches: _encode(shared)(batches), kinds)
        return staged(coded.withColumn("uid", F.monotonically_increasing_id()), "lm-encoded")

    def _fit(self, rounds, seed: int) -> np.ndarray:
        flat, low = _begin(self.log_share, self.d, seed), 0.0
        for i, high in enumerate(rounds):
            part = self.encoded.where(F.col("train") & (F.col("place") >= low) & (F.col("place") < high)).select("ids")
            walked = part.mapInArrow(_walk(self.log_share, flat, self.d, seed + i), "seen long, flat array<double>")
            mean = staged(walked.select("seen", F.posexplode("flat").alias("i", "x")).groupBy("i").agg(
                (F.sum(F.col("x") * F.col("seen")) / F.sum("seen")).alias("x")), "lm-round")
            found = mean.orderBy("i").toPandas()
            flat, low = found.x.to_numpy() if len(found) else flat, high
        return flat

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores by last and by last but one outcome (the first with biases), and the normalising sums of all contexts."""
        p = _Parameters(len(self.log_share), self.d, self.flat, np.float32)
        one, two = p.r @ p.c1, p.r @ p.c2
        first, second, k = one @ p.r.T + p.b, two @ p.r.T, len(self.log_share)

        def sums(batches):
            for batch in batches:
                found = []
                for x in batch.column("id").to_numpy():
                    logits = second + first[x]
                    top = logits.max(axis=1)
                    found.append(top + np.log(np.exp(logits - top[:, None]).sum(axis=1)))
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([x.tobytes() for x in found], pa.binary())], names=["id", "z"])

        z = self.spark.range(0, k, 1, 32).mapInArrow(sums, "id long, z binary").toPandas().sort_values("id")
        return first, second, np.stack([np.frombuffer(x, np.float32) for x in z.z])

    def score(self) -> DataFrame:
        """doc_id, train, n_tokens, n_known, base_score, score for every document; null texts are empty.

        Scores are base 10 logarithms. The base is add-one smoothed word frequency. Without any training text the model is the base.
        """
        shared = self.spark.sparkContext.broadcast((self.shared, self.tables()) if self.n else None)
        first_class = len(self.listed) + 1
        kept = ["uid", "doc_id", "train", "n_tokens", "n_known", "logs"]

        def run(batches):
            of_class, tables = shared.value
            shrink = np.concatenate([np.zeros(first_class), np.log10(of_class)])
            for batch in batches:
                for piece in _pieces(batch, "ids", PIECE):
                    ids, ends = _tokens(piece.column("ids"))
                    x, y = _contexts(ids, ends)
                    gains = (tables[0][x, ids] + tables[1][y, ids] - tables[2][x, y]) / math.log(10) - shrink[ids]
                    model = np.add.reduceat(gains, np.concatenate([[0], ends[:-1]]))
                    yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in kept), pa.array(model + piece.column("plain").to_numpy())],
                                                     names=[*kept, "model"])

        parts = self.encoded.select(*kept, "plain", "ids")
        if self.n:
            parts = parts.mapInArrow(run, "uid long, doc_id long, train boolean, n_tokens long, n_known long, logs double, model double")
        rare = self.encoded.select("uid", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("uid", F.col("x.rare").alias("word"), F.col("x.times").alias("times"))
        found = rare.join(self.counts, "word").groupBy("uid").agg(
            F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("more_logs"))
        out = parts.join(found, "uid", "left")
        logs, more = F.coalesce("more_logs", F.lit(0.0)), F.coalesce("more", F.lit(0))
        base = F.col("logs") + logs - F.col("n_tokens") * F.lit(math.log10(self.n + self.v + 1))
        score = F.col("model") + logs if self.n else base
        return out.select("doc_id", "train", "n_tokens", (F.col("n_known") + more).alias("n_known"), base.alias("base_score"), score.alias("score"))
