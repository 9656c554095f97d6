"""SimHash near-duplicates: fingerprints of repeated word shingles, linked where at most ``distance`` bits differ.

1. One pass gives each text its 64-bit fingerprint: a bit is set if it is set in over half of the XXH64 hashes of its shingles.
   Equal fingerprints collapse before anything meets, so copies cost nothing more.
2. Two fingerprints that differ in at most ``distance`` bits, cut into ``distance // 2 + 1`` segments, differ by at most one bit in
   one of them. Each fingerprint is indexed under every segment with every one of its bits blanked: 64 keys. Fingerprints
   that are near in a segment share such a key.
3. Rows of a key meet in one task, sorted; a key with more rows than ``cell`` is dealt to a grid of cells, so that no task holds more
   than two tiles of it. Pairs are compared there and never become rows: a cell returns a spanning forest of its links. A pair
   counts at its first shared key alone.
4. Forests give components; the smallest id reachable is the component's name.

The index has 64 rows per different fingerprint. A key of a 21-bit segment holds about one row in a million of evenly spread
fingerprints, so comparisons grow with the square of the corpus divided by a million, at some 10 ns each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import components, staged

U = np.uint64
SEED = 42
BITS = 64
BLOCK = 1 << 16  # shingle hashes, or index rows, worked on at a time


def segments(distance: int) -> list[tuple[int, int]]:
    """(first bit, width) of segments of which one differs by at most one bit when ``distance`` bits differ in all."""
    n = distance // 2 + 1
    ends = [BITS * i // n for i in range(n + 1)]
    return [(a, z - a) for a, z in zip(ends[:-1], ends[1:])]


def _hashes(text: bytes, width: int):
    """XXH64 of each shingle of one text, as arrays of bounded length."""
    words = text.lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return
    line, ends, at = b" ".join(words), [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    del words
    starts = [0, *(e + 1 for e in ends)]
    last, digest = ends[width - 1 :] or ends[-1:], xxhash.xxh64_intdigest
    for i in range(0, len(last), BLOCK):
        yield np.array([digest(line[a:z], SEED) for a, z in zip(starts[i:], last[i : i + BLOCK])], dtype=U)


def _ones(hashes: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """How often each bit is set in each stretch of ``hashes``; no stretch is empty."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.add.reduceat(bits, cuts, axis=0, dtype=np.int64)


def fingerprints(texts: list[bytes | None], width: int = 4) -> np.ndarray:
    """SimHash fingerprints of UTF-8 texts; 0 without words. Memory follows the longest text."""
    total, ones = np.zeros(len(texts), np.int64), np.zeros((len(texts), BITS), np.int64)
    held, owner, size = [], [], 0

    def count():
        nonlocal held, owner, size
        if held:
            rows = np.array(owner)
            cuts = np.concatenate([[0], np.cumsum([len(x) for x in held])[:-1]])
            np.add.at(ones, rows, _ones(np.concatenate(held), cuts))
            np.add.at(total, rows, [len(x) for x in held])
        held, owner, size = [], [], 0

    for row, text in enumerate(texts):
        for part in _hashes(text or b"", width):
            held.append(part)
            owner.append(row)
            size += len(part)
            if size >= BLOCK:
                count()
    count()
    return np.packbits(2 * ones > total[:, None], axis=1, bitorder="little").view("<u8").ravel().astype(U)


def _sign(width: int):
    def run(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            out = [fingerprints(texts.slice(i, 64).to_pylist(), width) for i in range(0, len(texts), 64)]
            prints = np.concatenate(out) if out else np.zeros(0, U)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints.view(np.int64))], names=["doc_id", "fp"])

    return run


def _forest(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The smallest row that each of ``n`` rows is linked with, itself included, along links (u, v)."""
    least = np.arange(n)
    while len(u):
        a, b = least[u], least[v]
        low = np.minimum(a, b)
        np.minimum.at(least, a, low)
        np.minimum.at(least, b, low)
        while True:
            up = least[least]
            if np.array_equal(up, least):
                break
            least = up
        open_ = least[u] != least[v]
        u, v = u[open_], v[open_]
    return least


def _near(keys, cells, tiles, prints, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of whole cells: rows sorted by key and cell; in a cell of two tiles only rows of different tiles meet."""
    n = len(prints)
    fresh = np.concatenate([[True], (keys[1:] != keys[:-1]) | (cells[1:] != cells[:-1])])
    group = np.cumsum(fresh) - 1
    ends = np.append(np.flatnonzero(fresh)[1:], n)[group]
    cuts = segments(distance)
    variant = keys >> 32
    seg_of = np.repeat(np.arange(len(cuts)), [w for _, w in cuts])[variant]
    least = np.arange(n)
    found_u, found_v, size = [], [], 0
    rows, lag = np.arange(n), 1
    while True:
        rows = rows[rows + lag < ends[rows]]
        if not len(rows):
            break
        x = prints[rows] ^ prints[rows + lag]
        hit = np.flatnonzero(np.bitwise_count(x) <= distance)
        if len(hit):
            a, x = rows[hit], x[hit]
            seg, bit = seg_of[a], variant[a]
            good = (cells[a] < 0) | (tiles[a] != tiles[a + lag])
            for s, (at, width) in enumerate(cuts):
                part = x & U(((1 << width) - 1) << at)
                good &= (seg <= s) | (np.bitwise_count(part) > 1)
                good &= (seg != s) | (part == U(1) << bit.astype(U)) | ((part == 0) & (bit == at))
            found_u.append(a[good])
            found_v.append(a[good] + lag)
            size += int(good.sum())
        if size > 1 << 20:
            u, v = np.concatenate([*found_u, np.arange(n)]), np.concatenate([*found_v, least])
            least, found_u, found_v, size = _forest(n, u, v), [], [], 0
        lag += 1
    if size:
        least = _forest(n, np.concatenate([*found_u, np.arange(n)]), np.concatenate([*found_v, least]))
    linked = np.flatnonzero(least != np.arange(n))
    return prints[linked], prints[least[linked]]


def _meet(distance: int):
    """Links among the rows of each (key, cell); the input is clustered and sorted so. Holds a block of rows and one cell."""

    def links(held):
        keys, cells, tiles, prints = (np.concatenate(x) for x in zip(*held))
        a, b = _near(keys, cells, tiles, prints.view(U), distance)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            now = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "cell", "tile", "fp")]
            held.append(now)
            size += batch.num_rows
            if size < BLOCK:
                continue
            key, cell = now[0], now[1]
            whole = np.flatnonzero((key != key[-1]) | (cell != cell[-1]))
            if not len(whole):
                continue
            cut = whole[-1] + 1
            yield links([*held[:-1], [x[:cut] for x in now]])
            held = [[x[cut:] for x in now]]
            size = batch.num_rows - cut
        if held:
            yield links(held)

    return run


class SimHash:
    """Groups ``docs`` by links between fingerprints of at most ``distance`` differing bits.

    Null and empty texts, and texts of white space alone, have fingerprint zero and link like any other. Repeated rows each
    get a row. Rows without an id take part but never name a component: one in which no row has an id has a null name.
    Extra columns are ignored.
    """

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, distance: int = 4, cell: int = 4096):
        self.width, self.distance, self.cell = width, distance, cell
        self.docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def prints(self) -> DataFrame:
        return staged(self.docs.mapInArrow(_sign(self.width), "doc_id long, fp long"), "sim-prints")

    def index(self, different: DataFrame) -> DataFrame:
        """(key, fp): each fingerprint under each segment with each of its bits blanked; the key's upper half is the blank's place."""
        def key(at: int, width: int, bit: int) -> Column:
            rest = ((1 << width) - 1) & ~(1 << (bit - at))
            return F.shiftrightunsigned("fp", at).bitwiseAND(F.lit(rest)) + F.lit(bit << 32)

        keys = [key(at, width, bit) for at, width in segments(self.distance) for bit in range(at, at + width)]
        return different.select("fp", F.explode(F.array(*keys)).alias("key"))

    def links(self, different: DataFrame) -> DataFrame:
        """(a, b): spanning links of near fingerprints."""
        index = self.index(different)
        crowded = (index.groupBy("key").agg(F.count("*").alias("m")).where(F.col("m") > self.cell)
                   .select("key", F.ceil(F.col("m") / self.cell).cast("long").alias("parts")))
        crowded = staged(crowded, "sim-crowded")
        rows = index.join(crowded, "key", "left")
        tile = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("parts"))
        # the cell of tiles i <= j is i * parts + j; -1 where all rows of the cell meet
        cell = F.when(F.col("u") == F.col("tile"), -1 - F.col("u")).otherwise(F.least("u", "tile") * F.col("parts") + F.greatest("u", "tile"))
        lone = rows.where("parts IS NULL").select("key", F.lit(-1).cast("long").alias("cell"), F.lit(0).cast("long").alias("tile"), "fp")
        dealt = (rows.where("parts IS NOT NULL").withColumn("tile", tile)
                 .select("key", "fp", "tile", "parts", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("u"))
                 .select("key", cell.alias("cell"), "tile", "fp"))
        met = lone.union(dealt).repartition("key", "cell").sortWithinPartitions("key", "cell")
        return staged(met.mapInArrow(_meet(self.distance), "a long, b long").distinct(), "sim-links", rows=10_000)

    def groups(self) -> DataFrame:
        """doc_id, fp, component_id; one row per row of ``docs``."""
        rows = self.prints()
        different = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "sim-different")
        roots = components(self.links(different), "sim-roots")
        rooted = different.join(roots, different.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
        named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
        of_print = staged(rooted.join(named, "root").select("fp", "component_id"), "sim-names")
        return rows.join(of_print, "fp").select("doc_id", "fp", "component_id")


def sim_duplicates(docs: DataFrame, **options) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id."""
    found = SimHash(docs, **options).groups()
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
