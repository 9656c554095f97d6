"""Exact duplicates by composable polynomial fingerprints.

A text, with every run of white space as one space, is a polynomial in its bytes. Its fingerprint is that polynomial at two
fixed points modulo a prime, and its length. Fingerprints of chunks compose: shifting by a chunk's length is one
multiplication, so chunks of a huge document are hashed in parallel and folded. Documents with equal fingerprints are then
compared chunk by chunk: every chunk's smallest and largest text must agree, which partial aggregation settles without
bringing a group together. Groups that differ somewhere are split by their chunks' contents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.common import GAP, staged

PRIME = (1 << 31) - 1
POINTS = (1_103_515_245, 1_664_525_017)
CHUNK = 1 << 16


def _powers(point: int, n: int) -> np.ndarray:
    """point**(n-1), ..., point**0 modulo the prime."""
    out, x = np.ones(n, dtype=np.uint64), 1
    for i in range(n - 1, -1, -1):
        out[i] = x
        x = x * point % PRIME
    return out


def _hash_pieces(points: tuple[int, ...], chunk: int):
    """Polynomial hashes h1, h2 of a binary column of at most ``chunk`` bytes each, and the shifts s1, s2 of that length.

    A byte times a power stays below 2**39, so that a whole chunk adds up in 64 bits before the one remainder.
    """

    def run(batches):
        powers = [_powers(p, chunk + 1) for p in points]
        for batch in batches:
            pieces = batch.column("piece")
            bounds = np.frombuffer(pieces.buffers()[1], dtype=np.int32)[pieces.offset : pieces.offset + len(pieces) + 1]
            data = np.frombuffer(pieces.buffers()[2], dtype=np.uint8) if pieces.buffers()[2] is not None else np.zeros(0, np.uint8)
            found = np.zeros((4, len(pieces)), dtype=np.int64)
            for i, (a, z) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                raw = data[a:z].astype(np.uint64)
                for k in (0, 1):
                    found[k, i] = int(np.dot(raw + np.uint64(1), powers[k][chunk + 1 - len(raw) :])) % PRIME
                    found[2 + k, i] = powers[k][chunk - len(raw)]
            keep = [c for c in batch.schema.names if c != "piece"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *map(pa.array, found)], names=[*keep, "h1", "h2", "s1", "s2"])

    return run


class ExactDuplicates:
    """Groups ``docs`` by equal texts; null counts as empty, and all empty texts are equal.

    Of a group the row with the smallest id stays; of several such rows, one. Rows without an id come last: one stays only
    where no row of the group has an id, and ``keep_id`` is then null.
    """

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", points: tuple[int, ...] = POINTS, chunk: int = CHUNK):
        self.points, self.chunk = points, chunk
        text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
        self.docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("rk"), text.alias("raw"))
        self.text = F.regexp_replace("raw", GAP, " ")

    def _pieces(self, rows: DataFrame, *keep: str) -> DataFrame:
        """One row per chunk (no, piece) of the rows' texts; an empty text is one empty chunk."""
        rows = rows.withColumn("whole", self.text.cast("binary"))
        last = F.greatest(F.floor((F.octet_length("whole") - 1) / self.chunk), F.lit(0)).cast("int")
        rows = rows.select(*keep, "whole", F.explode(F.sequence(F.lit(0), last)).alias("no"))
        return rows.select(*keep, "no", F.substring("whole", F.col("no") * self.chunk + 1, F.lit(self.chunk)).alias("piece"))

    def _hashed(self, pieces: DataFrame) -> DataFrame:
        kinds = ", ".join(f"{c} {t}" for c, t in pieces.dtypes if c != "piece")
        return pieces.mapInArrow(_hash_pieces(self.points, self.chunk), f"{kinds}, h1 long, h2 long, s1 long, s2 long")

    def fingerprints(self) -> DataFrame:
        """doc_id, rk, sha, n (bytes), f1, f2 and a row number ``uid``, for every row."""
        rows = self.docs.select("doc_id", "rk", "raw", F.sha2(self.text, 256).alias("sha"), F.octet_length(self.text).alias("n"))
        size = F.octet_length("raw")
        short = rows.where(size <= self.chunk).select("doc_id", "rk", "sha", "n", self.text.cast("binary").alias("piece"))
        short = self._hashed(short).select("doc_id", "rk", "sha", "n", F.col("h1").alias("f1"), F.col("h2").alias("f2"))
        long_ = rows.where(size > self.chunk)
        # Chunks of long texts are dealt out, hashed apart and folded in order.
        chunks = self._pieces(long_, "doc_id", "rk", "sha", "n").repartition("doc_id", "rk", "no")
        chunks = staged(self._hashed(chunks), "exact-chunks", rows=200)
        parts = F.array_sort(F.collect_set(F.struct("no", "h1", "h2", "s1", "s2")))
        fold = F.aggregate("parts", F.struct(F.lit(0).cast("long").alias("f1"), F.lit(0).cast("long").alias("f2")), lambda acc, x: F.struct(
            ((acc["f1"] * x["s1"] + x["h1"]) % PRIME).alias("f1"), ((acc["f2"] * x["s2"] + x["h2"]) % PRIME).alias("f2")))
        folded = chunks.groupBy("doc_id", "rk", "sha", "n").agg(parts.alias("parts")).select(
            F.col("doc_id").alias("l_id"), F.col("rk").alias("l_rk"), fold.alias("f"))
        same = F.col("doc_id").eqNullSafe(F.col("l_id")) & (F.col("rk") == F.col("l_rk"))
        folded = chunks.where("no = 0").join(folded, same).select("doc_id", "rk", "sha", "n", "f.f1", "f.f2")
        return staged(short.unionByName(folded).withColumn("uid", F.monotonically_increasing_id()), "exact-prints")

    def groups(self) -> DataFrame:
        """doc_id, keep_id, group_size, kept, text_sha256; one row per row."""
        prints, key = self.fingerprints(), ["n", "f1", "f2"]
        many = staged(prints.groupBy(*key).agg(F.count("*").alias("rows")).where("rows > 1").drop("rows"), "exact-shared")
        members = staged(prints.join(many, key).select("doc_id", "rk", *key).distinct(), "exact-members")
        same = F.col("doc_id").eqNullSafe(F.col("m_id")) & (F.col("rk") == F.col("m_rk"))
        texts = self.docs.join(members.withColumnsRenamed({"doc_id": "m_id", "rk": "m_rk"}).hint("shuffle_hash"), same)
        pieces = self._pieces(texts, *key, "doc_id", "rk")
        differing = (pieces.groupBy(*key, "no").agg(F.min("piece").alias("lo"), F.max("piece").alias("hi")).where("lo != hi")
                     .select(*key).distinct())
        differing = staged(differing, "exact-differing")
        part = F.lit(None).cast("array<int>")
        if not differing.isEmpty():
            # Equal fingerprints of different texts: the rank of each chunk among its group's chunks tells the texts apart.
            ranked = pieces.join(differing, key).withColumn("rank", F.dense_rank().over(Window.partitionBy(*key, "no").orderBy("piece")))
            ranked = ranked.select("doc_id", "rk", "no", "rank").distinct().groupBy("doc_id", "rk").agg(
                F.transform(F.array_sort(F.collect_list(F.struct("no", "rank"))), lambda x: x["rank"]).alias("part"))
            ranked = ranked.withColumnsRenamed({"doc_id": "m_id", "rk": "m_rk"})
            prints = staged(prints.join(ranked, same, "left").drop("m_id", "m_rk"), "exact-parted")
        else:
            prints = prints.withColumn("part", part)
        first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "uid"))
        found = prints.join(many, key).groupBy(*key, "part").agg(F.count("*").alias("rows"), first.alias("first"))
        found = staged(found.withColumnsRenamed({**{c: f"g_{c}" for c in key}, "part": "g_part"}), "exact-groups")
        match = F.col("part").eqNullSafe(F.col("g_part"))
        for c in key:
            match = match & (F.col(c) == F.col(f"g_{c}"))
        out = prints.join(found, match, "left")
        return out.select(
            "doc_id", F.when(F.col("rows").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
            F.coalesce("rows", F.lit(1)).cast("long").alias("group_size"),
            (F.col("rows").isNull() | (F.col("uid") == F.col("first.uid"))).alias("kept"), F.col("sha").alias("text_sha256"))


def exact_duplicates(docs: DataFrame, **options) -> DataFrame:
    return ExactDuplicates(docs, **options).groups()
