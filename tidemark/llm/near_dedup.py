"""Near-duplicate grouping: SuperMinHash signatures, banding, verification on full shingle sets, connected components.

1. One pass over the texts gives each document its number of distinct five-word shingles, a fingerprint of the set and a
   signature. Documents with equal sets form a class; everything after works on classes, so copies cost nothing more.
2. Signatures are cut into bands. Classes that share a band meet the smallest class of that band, never each other: a star per
   band. Pairs whose lengths or signatures rule out the threshold go before any text moves.
3. The rest is verified on whole texts; verified links give components.
4. Classes of bands that still hold different components are open. Two sets that reach the threshold share one of their
   rarest shingles, if each brings n - ceil(threshold n) + 1 of them in a common order. Shingles of one component alone come first
   in that order, common passages last, so that only few open classes meet. Classes outside a large component are counted
   against its members in cells of bounded size, the rest in pairs. Their links complete the components.

A pair at the threshold shares no band with a chance of (1 - 0.75**4)**32 = 5e-6, and is dropped by its signature with
less than that.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import components, staged
from tidemark.llm.shingles import U, mix, shingle_sets, super_minhash

ROWS = "doc_id long, rk long, n long, f1 long, f2 long, sig array<short>"


def _first():
    """The first row of a group: by id, those without one last, then by hash of the text."""
    return F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "rk"))


def _sign(size: int, width: int):
    def run(batches):
        for batch in batches:
            n, f1, f2, sigs = [], [], [], []
            for _, hashes, ends in shingle_sets(batch.column("text"), width):
                sig = super_minhash(hashes, ends, size)
                sigs.append((mix(sig) & U(0xFFFF)).astype(np.uint16).view(np.int16))
                n.append(np.diff(ends))
                with np.errstate(over="ignore"):
                    for out, salt in ((f1, 0x243F6A8885A308D3), (f2, 0x13198A2E03707344)):
                        sums = np.concatenate([np.zeros(1, dtype=U), np.cumsum(mix(hashes ^ U(salt)))])
                        out.append((sums[ends[1:]] - sums[ends[:-1]]).view(np.int64))
            if not n:
                continue
            flat = np.concatenate(sigs)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("rk"), pa.array(np.concatenate(n).astype(np.int64)),
                pa.array(np.concatenate(f1)), pa.array(np.concatenate(f2)),
                pa.ListArray.from_arrays(pa.array(np.arange(len(flat) + 1, dtype=np.int32) * size), pa.array(flat.ravel())),
            ], names=["doc_id", "rk", "n", "f1", "f2", "sig"])

    return run


def _verify(width: int):
    def run(batches):
        def sets_of(ids, texts):
            """One set per different id of the batch."""
            first = {}
            for i, x in enumerate(ids):
                first.setdefault(x, i)
            rows, sets = list(first.values()), []
            for _, hashes, ends in shingle_sets(texts.take(pa.array(rows)), width):
                sets.extend(hashes[a:z] for a, z in zip(ends[:-1], ends[1:]))
            return dict(zip(first, sets))

        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            left, right = sets_of(a, batch.column("a_text")), sets_of(b, batch.column("b_text"))
            both = np.array([len(np.intersect1d(left[x], right[y], assume_unique=True)) for x, y in zip(a, b)], dtype=np.int64)
            either = np.array([len(left[x]) + len(right[y]) for x, y in zip(a, b)], dtype=np.int64) - both
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(both), pa.array(either)],
                                             names=["a", "b", "both", "either"])

    return run


def _spread(width: int):
    """The number and the hashes of each text's shingles."""

    def run(batches):
        for batch in batches:
            parts, sizes = [], [0]
            for _, hashes, ends in shingle_sets(batch.column("text"), width):
                parts.append(hashes)
                sizes.extend(np.diff(ends).tolist())
            flat = np.concatenate(parts) if parts else np.zeros(0, dtype=U)
            yield pa.RecordBatch.from_arrays([
                batch.column("cid"), pa.array(sizes[1:], pa.int32()),
                pa.ListArray.from_arrays(pa.array(np.cumsum(sizes).astype(np.int32)), pa.array(flat.view(np.int64))),
            ], names=["cid", "n", "g"])

    return run


def _meet(percent: int):
    """Links from left sets to right ones: to each that is marked so, and to one of the others; exact, by an inverted list."""

    def run(left, right):
        out, sizes = ([], []), right.column("n").to_numpy()
        if left.num_rows and right.num_rows:
            tokens = right.column("g").combine_chunks()
            owner = np.repeat(np.arange(len(sizes)), sizes)
            flat = tokens.flatten().to_numpy()
            order = np.argsort(flat, kind="stable")
            flat, owner = flat[order], owner[order]
            ids, each = right.column("cid").to_numpy(), right.column("each").to_numpy()
            for cid, n, own in zip(left.column("cid").to_pylist(), left.column("n").to_pylist(), left.column("g")):
                own = own.values.to_numpy()
                first, last = np.searchsorted(flat, own, "left"), np.searchsorted(flat, own, "right")
                some = last > first
                first, length = first[some], (last - first)[some]
                at = np.repeat(first - np.concatenate([[0], np.cumsum(length)[:-1]]) if len(length) else first, length) + np.arange(length.sum())
                both = np.bincount(owner[at], minlength=len(sizes))
                linked = np.flatnonzero(100 * both >= percent * (n + sizes - both))
                linked = np.concatenate([linked[each[linked]], linked[~each[linked]][:1]])
                out[0].extend([cid] * len(linked))
                out[1].extend(ids[linked].tolist())
        return pa.table([pa.array(x, pa.int64()) for x in out], names=["a", "b"])

    return run


class NearDuplicates:
    """Groups ``docs`` by the links between texts that share ``percent`` of all their distinct shingles.

    ``docs`` needs the id and text columns; others are ignored. A row is known by id and text, so repeated rows share one
    result. Null and empty texts have no shingles, no links, and themselves as component. Rows without an id take part; they
    never name a component, and form one without a name when no linked row has an id. Texts of fewer than ``width``
    words count as one shingle.
    """

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75, width: int = 5,
                 bands: int = 32, rows: int = 4, floor: float = 0.5, large: int = 32, cell: int = 200_000):
        self.percent, self.width, self.bands, self.rows, self.floor = percent, width, bands, rows, floor
        self.large, self.cell = large, cell
        self.docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("rk"),
                                F.col(text_col).cast("string").alias("text"))

    def signatures(self) -> DataFrame:
        return staged(self.docs.mapInArrow(_sign(self.bands * self.rows, self.width), ROWS), "near-rows")

    def classes(self, rows: DataFrame) -> DataFrame:
        """One row per different shingle set: cid, its first row, size and signature."""
        found = (rows.where("n > 0").groupBy("f1", "f2", "n")
                 .agg(_first().alias("rep"), F.first("sig").alias("sig")))
        return staged(found.select(F.monotonically_increasing_id().alias("cid"), "f1", "f2", "n", "rep.doc_id", "rep.rk", "sig"), "near-classes")

    def buckets(self, classes: DataFrame) -> DataFrame:
        """(band, cid, lead) of the bands that more than one class has. Leads are drawn anew for every fourth part of the bands, so
        that a large group has several centres."""
        band = [F.struct(F.xxhash64(F.slice("sig", b * self.rows + 1, self.rows), F.lit(b)).alias("band"), F.lit(b % 4).alias("turn"))
                for b in range(self.bands)]
        rows = classes.select("cid", F.explode(F.array(*band)).alias("b")).select("cid", "b.band", F.xxhash64("cid", "b.turn").alias("draw"))
        shared = rows.groupBy("band").agg(F.min("draw").alias("draw"), F.max("draw").alias("last")).where("draw != last")
        leads = rows.join(shared.select("band", "draw"), ["band", "draw"]).groupBy("band").agg(F.min("cid").alias("lead"))
        return staged(rows.select("band", "cid").join(leads, "band"), "near-buckets")

    def verified(self, pairs: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
        """(a, b, both, either) of those pairs that lengths and signatures leave possible."""
        info = classes.select("cid", "n", "sig")
        same = F.size(F.filter(F.zip_with("sig", "b_sig", lambda x, y: x == y), lambda x: x))
        size = self.bands * self.rows
        possible = (pairs.join(info.withColumnRenamed("cid", "a"), "a")
                    .join(info.select(F.col("cid").alias("b"), F.col("n").alias("b_n"), F.col("sig").alias("b_sig")), "b")
                    .where(F.least("n", "b_n") * 100 >= F.greatest("n", "b_n") * self.percent)
                    .where(same >= self.floor * size).select("a", "b"))
        rows = (possible.join(texts.select(F.col("cid").alias("a"), F.col("text").alias("a_text")), "a")
                .join(texts.select(F.col("cid").alias("b"), F.col("text").alias("b_text")), "b"))
        return rows.select("a", "b", "a_text", "b_text").mapInArrow(_verify(self.width), "a long, b long, both long, either long")

    def _links(self, checked: DataFrame) -> DataFrame:
        return checked.where(f"100 * both >= {self.percent} * either").select("a", "b")

    def open_classes(self, buckets: DataFrame, roots: DataFrame) -> DataFrame:
        """(cid, root) of the classes of bands that hold more than one component."""
        root = F.coalesce("root", "cid").alias("root")
        member = buckets.join(roots, buckets.cid == roots.node, "left").select("band", "cid", root)
        mixed = member.groupBy("band").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi").select("band")
        return staged(member.join(mixed, "band").select("cid", "root").distinct(), "near-open")

    def rare_shingles(self, sets: DataFrame, roots: DataFrame) -> DataFrame:
        """(cid, root, n, most, g): the rarest shingles of open classes, by which classes of different components can reach the
        threshold; ``most`` of their shingles occur in several components, which bounds what two classes share."""
        each = sets.join(roots, sets.cid == roots.node, "left").select("cid", F.coalesce("root", "cid").alias("root"), "n", F.explode("g").alias("g"))
        crossing = each.groupBy("g").agg(F.count("*").alias("df"), F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi")
        own = each.join(crossing.select("g", "df"), "g").groupBy("cid", "root", "n").agg(F.array_sort(F.collect_list(F.struct("df", "g"))).alias("g"))
        prefix = F.col("n") - F.ceil(F.col("n") * self.percent / 100) + 1 - (F.col("n") - F.size("g"))
        rare = own.withColumn("take", prefix.cast("int")).where("take > 0").select(
            "cid", "root", "n", F.size("g").alias("most"), F.explode(F.slice("g", F.lit(1), F.col("take"))).alias("x"))
        return staged(rare.select("cid", "root", "n", "most", "x.g"), "near-rare")

    def outsiders(self, rare: DataFrame, large: DataFrame) -> DataFrame:
        """(cid, into): open classes and the large components outside them with which they share a rare shingle. Of two large
        components the smaller one counts as outside."""
        rows = rare.join(large, "root", "left").select("g", "cid", "root", F.coalesce("m", F.lit(0)).alias("m"))
        inside = rows.where("m > 0").select("g", F.col("root").alias("into"), F.col("m").alias("into_m")).distinct()
        before = F.struct("m", "root") < F.struct(F.col("into_m").alias("m"), F.col("into").alias("root"))
        return staged(rows.join(inside, "g").where(before).select("cid", "into").distinct(), "near-outside")

    def against_large(self, rare: DataFrame, large: DataFrame, sets: DataFrame, outside: DataFrame) -> DataFrame:
        """(a, b): the links of the outsiders of each large component among each other, and one of each into it, if any.

        They meet in a grid of cells of bounded size, in which overlaps are counted by an inverted list; pairs are never rows.
        """
        inside = rare.select("cid", "root").distinct().join(large.select("root"), "root").select("cid", F.col("root").alias("into"))
        outside = outside.join(sets, "cid").select("cid", "n", "g", "into")
        both = inside.join(sets, "cid").select("cid", "n", "g", "into", F.lit(False).alias("each")).union(outside.withColumn("each", F.lit(True)))
        both, outside = staged(both, "near-inside"), staged(outside, "near-outside-sets")
        parts = both.groupBy("into").agg(F.ceil(F.sum("n") / self.cell).cast("int").alias("i_n")).join(
            outside.groupBy("into").agg(F.ceil(F.sum("n") / self.cell).cast("int").alias("j_n")), "into")

        def dealt(side, own, other):
            place = F.pmod(F.xxhash64("cid"), F.col(f"{own}_n").cast("long")).cast("int").alias(own)
            return side.join(parts, "into").select(*side.columns, place, F.explode(F.sequence(F.lit(0), F.col(f"{other}_n") - 1)).alias(other))

        key = ["into", "i", "j"]
        met = dealt(outside, "j", "i").groupBy(*key).cogroup(dealt(both, "i", "j").groupBy(*key))
        return met.applyInArrow(_meet(self.percent), "a long, b long")

    def across(self, rare: DataFrame, roots: DataFrame, outside: DataFrame) -> DataFrame:
        """Pairs of classes of different components that share one of their rarest shingles and enough shingles at all, and have not
        met as outsiders of one component."""
        met_at = outside.groupBy("cid").agg(F.collect_set("into").alias("met"))
        rare = rare.join(met_at, "cid", "left").join(roots, rare.cid == roots.node, "left")
        rare = staged(rare.select("g", "cid", "n", "most", "met", F.coalesce(roots.root, "cid").alias("root")), "near-rooted")
        left, right = (rare.select("g", *(F.col(c).alias(f"{side}_{c}") for c in ("cid", "root", "n", "most", "met"))) for side in "ab")
        most = F.least("a_most", "b_most")
        pairs = left.join(right, "g").where("a_cid < b_cid and a_root != b_root").where(
            100 * most >= self.percent * (F.col("a_n") + F.col("b_n") - most)).where(~F.coalesce(F.arrays_overlap("a_met", "b_met"), F.lit(False)))
        return pairs.select(F.col("a_cid").alias("a"), F.col("b_cid").alias("b")).distinct()

    def rooted(self, rows: DataFrame) -> DataFrame:
        """Classes (f1, f2, n, first row) with the root of their group."""
        classes = self.classes(rows)
        buckets = self.buckets(classes)
        wanted = classes.join(buckets.select("cid").distinct(), "cid").select("cid", F.col("doc_id").alias("w_id"), F.col("rk").alias("w_rk"))
        found = self.docs.join(wanted.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("w_id")) & (F.col("rk") == F.col("w_rk")))
        texts = staged(found.select("cid", "text"), "near-texts")
        stars = buckets.where("cid != lead").select(F.col("cid").alias("a"), F.col("lead").alias("b")).distinct()
        checked = staged(self.verified(stars, classes, texts), "near-checked", rows=500)
        links = self._links(checked)
        roots = components(links, "near-roots")
        opened = self.open_classes(buckets, roots).join(texts, "cid").select("cid", "text")
        sets = staged(opened.mapInArrow(_spread(self.width), "cid long, n int, g array<long>").dropDuplicates(["cid"]), "near-sets")
        rare = self.rare_shingles(sets, roots)
        large = staged(rare.select("cid", "root").distinct().groupBy("root").agg(F.count("*").alias("m")).where(F.col("m") >= self.large), "near-large")
        outside = self.outsiders(rare, large)
        joined = staged(self.against_large(rare, large, sets, outside), "near-joined")
        if not joined.isEmpty():
            links = links.union(joined)
            roots = components(links, "near-roots")
        pairs = self.across(rare.join(large, "root", "left_anti").drop("root"), roots, outside)
        more = self._links(staged(self.verified(pairs, classes, texts), "near-more", rows=500))
        if not more.isEmpty():
            roots = components(links.union(more), "near-roots")
        return classes.join(roots, classes.cid == roots.node, "left").select("f1", "f2", "n", "doc_id", "rk", F.coalesce("root", "cid").alias("root"))

    def survivors(self) -> DataFrame:
        """doc_id, rk of the first row of each group of texts with shingles, whether or not its rows have ids."""
        first = self.rooted(self.signatures()).groupBy("root").agg(_first().alias("first"))
        return first.select("first.doc_id", "first.rk")

    def groups(self) -> DataFrame:
        """doc_id, rk (hash of the text), n_shingles, component_id, kept; one row per row of ``docs``."""
        rows = self.signatures()
        rooted = self.rooted(rows)
        named = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
        of_class = rooted.join(named, "root").select("f1", "f2", "n", "component_id")
        out = rows.join(of_class, ["f1", "f2", "n"], "left")
        component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
        return out.select("doc_id", "rk", F.col("n").alias("n_shingles"), component.alias("component_id"),
                          F.col("doc_id").eqNullSafe(component).alias("kept"))


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    return NearDuplicates(docs, **options).groups()
