"""A trie of conversation prefixes: conversations that begin alike share nodes, and only prefixes that may be shared are shuffled.

1. Turns become two 64-bit hashes and a length before anything moves. A prefix's digest is the exclusive or of its turns' hashes,
   each mixed with its place, so that the digest of the prefix one turn shorter is at hand as well.
2. A count-min sketch counts prefix digests: each task counts its own rows, saturating at two, and pages of counters are merged.
   An estimate of one proves that no other conversation has the prefix.
3. A prefix proven single whose parent is proven single too is emitted where it lies: a node of one member. The rest is grouped
   by exact digests. An estimate that is too high sends a row there needlessly and changes no result.
4. A conversation owns the nodes whose smallest member it is: a node's ancestors are prefixes of its owner. So totals over
   subtrees are sums over a conversation's own rows from the end, then over members.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import staged
from tidemark.llm.shingles import U, mix
from tidemark.operators.scan import Blocks

PAGE = 1 << 14  # counters
KEY = ["x1", "x2", "depth"]
NO_ENDS = hashlib.sha256(b"").hexdigest()


class Sketch:
    """Place of digests in ``lines`` lines of ``width`` counters."""

    def __init__(self, width: int, lines: int):
        self.width, self.lines = width, lines

    def places(self, x1: np.ndarray, x2: np.ndarray, line: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (mix(x1 + mix(x2 + U(line))) & U(self.width - 1)).astype(np.int64) + line * self.width

    def count(self):
        """Pages of the counters of a task's rows as bits: those of one or more, those of two or more."""
        def run(batches):
            seen = np.zeros(self.width * self.lines, dtype=np.uint8)
            for batch in batches:
                x1, x2 = (batch.column(c).to_numpy(zero_copy_only=False).view(U) for c in ("x1", "x2"))
                for line in range(self.lines):
                    at, times = np.unique(self.places(x1, x2, line), return_counts=True)
                    seen[at] = np.minimum(2, seen[at] + times)
            pages = seen.reshape(-1, min(PAGE, self.width))
            used = np.flatnonzero(pages.any(axis=1))
            for i in range(0, len(used), 256):
                some = used[i : i + 256]
                yield pa.RecordBatch.from_arrays([
                    pa.array(some), pa.array([np.packbits(pages[p] > 0).tobytes() for p in some], pa.binary()),
                    pa.array([np.packbits(pages[p] > 1).tobytes() for p in some], pa.binary())], names=["page", "once", "twice"])

        return run

    @staticmethod
    def merge(key, pages):
        """Counters of two or more of one page, from all tasks' pages."""
        size = len(pages["once"][0].as_py())
        once, twice = np.zeros(size, np.uint8), np.zeros(size, np.uint8)
        for a, b in zip(pages["once"], pages["twice"]):
            a, b = np.frombuffer(a.as_py(), np.uint8), np.frombuffer(b.as_py(), np.uint8)
            twice |= b | once & a
            once |= a
        return pa.table([pa.array([key[0].as_py()], pa.int64()), pa.array([twice.tobytes()], pa.binary())], names=["page", "twice"])

    def screen(self, shared):
        """Adds whether the prefix, and the one before it, may be shared; ``shared`` broadcasts the bits of counters of two or more."""
        def run(batches):
            bits = np.frombuffer(shared.value, np.uint8)

            def maybe(batch, a, b):
                x1, x2 = (batch.column(c).to_numpy(zero_copy_only=False).view(U) for c in (a, b))
                out = np.ones(len(x1), bool)
                for line in range(self.lines):
                    at = self.places(x1, x2, line)
                    out &= (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
                return out

            for batch in batches:
                first = batch.column("depth").to_numpy(zero_copy_only=False) == 1
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(maybe(batch, "x1", "x2")), pa.array(maybe(batch, "y1", "y2") & ~first)],
                    names=[*batch.schema.names, "shared", "after_shared"])

        return run


def _digest_ends(batches):
    """SHA-256 of each node's pieces in order; the input is clustered by node and sorted, and only a running hash is held."""
    now, running = None, None
    out = []
    for batch in batches:
        for *key, piece in zip(*(batch.column(c).to_pylist() for c in (*KEY, "piece"))):
            if key == now:
                running.update(b",")
            else:
                if now is not None:
                    out.append((*now, running.hexdigest()))
                now, running = key, hashlib.sha256()
            running.update(piece.encode())
        if out:
            yield _ends(out)
            out = []
    if now is not None:
        yield _ends([(*now, running.hexdigest())])


def _ends(rows):
    return pa.RecordBatch.from_arrays(
        [*(pa.array(x, pa.int64()) for x in list(zip(*rows))[:3]), pa.array([r[3] for r in rows], pa.string())], names=[*KEY, "ends_sha256"])


class PrefixTrie:
    """The trie of ``turns`` (conv_id, turn, role, text), one conversation per conv_id, in order of turn (null first).

    Null roles and texts are empty. Equal turn numbers are ordered by hash of role and text, so that repeated rows are turns of their
    own. Rows without a conv_id belong to no conversation. Extra columns are ignored; without rows there are no nodes.

    ``borrow`` rebuilds conversations first: conversation c takes the first h turns of conversation c - c % ``borrow`` (all if it
    has fewer, none if absent) in place of its own first h, h being crc32 of c in decimal modulo ``heads``.

    The sketch has ``lines`` lines of eight counters per prefix, at most ``max_width``: that bounds what is broadcast to
    ``lines * max_width / 8`` bytes. Beyond it more prefixes are grouped exactly; results are the same.
    """

    def __init__(self, turns: DataFrame, borrow: int | None = None, heads: int = 6, lines: int = 3, max_width: int = 1 << 24):
        role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
        self.turns = turns.where(F.col("conv_id").isNotNull()).select(
            F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.xxhash64(role, text).alias("t1"),
            F.xxhash64(F.lit("second"), text, role).alias("t2"), F.length(text).cast("long").alias("chars"))
        self.borrow, self.heads, self.lines, self.max_width = borrow, heads, lines, max_width

    @staticmethod
    def _mixed(depth, t1, t2):
        return F.xxhash64(t1, t2, depth), F.xxhash64(depth, t2, t1)

    @staticmethod
    def _folded(turns, e):
        return F.aggregate(turns, F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(x[e]))

    def prefixes(self) -> tuple[DataFrame, DataFrame]:
        """(conv_id, depth, digest, digest of the prefix before, chars, last) of all prefixes with turns; (conv_id, total) of all conversations."""
        order = ["turn", "t1", "t2"]
        c = F.col("conv_id")
        if self.borrow:
            base, h = c - c % self.borrow, (F.crc32(c.cast("string")) % self.heads).cast("long")
            # only the first few turns of one conversation in ``borrow`` are kept, by a limit per task before the shuffle
            first = F.expr("row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, t1, t2)")
            head = (self.turns.where(c % self.borrow == 0).withColumn("pos", first.cast("long")).where(F.col("pos") < self.heads)
                    .withColumns(dict(zip(("e1", "e2"), self._mixed(F.col("pos"), F.col("t1"), F.col("t2"))))))
            head = head.groupBy(c.alias("base")).agg(F.array_sort(F.collect_list(F.struct("pos", "e1", "e2", "chars"))).alias("head"))
            head = staged(head, "trie-heads")
            rows = self.turns.withColumns({"base": base, "h": h})
            lent = rows.join(head, "base", "left").withColumn("head", F.coalesce(F.slice("head", F.lit(1), F.col("h").cast("int")), F.array()))
            lent = lent.withColumns({"shift": F.size("head") - F.col("h"), "g1": self._folded(F.col("head"), "e1"), "g2": self._folded(F.col("head"), "e2")})
            rows = lent.drop("base", "head")
        else:
            zero = F.lit(0).cast("long")
            rows = self.turns.withColumns({"h": zero, "shift": zero, "g1": zero, "g2": zero})
        placed = Blocks(rows.withColumn("one", F.lit(1).cast("long")), ["conv_id"], order, label="trie-turns")
        placed = placed.running(pos=("sum", "one"), totals={"turns": ("sum", "one")})
        depth = F.col("pos") + F.col("shift")
        kept = F.col("pos") > F.col("h")
        e1, e2 = self._mixed(depth, F.col("t1"), F.col("t2"))
        zero = F.lit(0).cast("long")
        placed = placed._with(placed.df.withColumns({"e1": F.when(kept, e1).otherwise(zero), "e2": F.when(kept, e2).otherwise(zero)}))
        placed = placed.running(p1=("xor", "e1"), p2=("xor", "e2"))
        total = F.col("shift") + F.greatest("turns", "h")
        numbered = staged(placed.rows().select(
            "conv_id", "pos", "h", depth.alias("depth"), total.alias("total"), "e1", "e2", F.col("p1").bitwiseXOR(F.col("g1")).alias("x1"),
            F.col("p2").bitwiseXOR(F.col("g2")).alias("x2"), "chars"), "trie-numbered", rows=10_000)
        convs = numbered.where("pos = 1").select("conv_id", "h", "total")
        own = numbered.where("pos > h").select(
            "conv_id", "depth", "x1", "x2", F.col("x1").bitwiseXOR(F.col("e1")).alias("y1"), F.col("x2").bitwiseXOR(F.col("e2")).alias("y2"), "chars",
            (F.col("depth") == F.col("total")).alias("last"))
        if not self.borrow:
            return own, convs

        def upto(n, e):
            return self._folded(F.slice("head", F.lit(1), n), e)

        lent = (convs.withColumn("base", base).join(head, "base")
                .withColumn("head", F.slice("head", F.lit(1), F.col("h").cast("int"))).where(F.size("head") > 0)
                .select("conv_id", "total", "head", F.explode("head").alias("x")))
        n = F.col("x.pos").cast("int")
        lent = lent.select(
            "conv_id", F.col("x.pos").alias("depth"), upto(n, "e1").alias("x1"), upto(n, "e2").alias("x2"), upto(n - 1, "e1").alias("y1"),
            upto(n - 1, "e2").alias("y2"), F.col("x.chars").alias("chars"), (F.col("x.pos") == F.col("total")).alias("last"))
        return own.unionByName(lent), convs

    def screened(self, rows: DataFrame) -> DataFrame:
        spark = rows.sparkSession
        n = rows.count()
        width = min(self.max_width, max(1 << 10, 1 << max(0, 8 * n - 1).bit_length()))
        sketch = Sketch(width, self.lines)
        pages = (rows.select("x1", "x2").mapInArrow(sketch.count(), "page long, once binary, twice binary")
                 .groupBy("page").applyInArrow(sketch.merge, "page long, twice binary"))
        bits, page = np.zeros(width * self.lines // 8, np.uint8), min(PAGE, width) // 8
        for r in pages.collect():  # at most ``lines * max_width / 8`` bytes
            bits[r["page"] * page : (r["page"] + 1) * page] = np.frombuffer(r["twice"], np.uint8)
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
        return rows.mapInArrow(sketch.screen(spark.sparkContext.broadcast(bits.tobytes())), f"{schema}, shared boolean, after_shared boolean")

    def ends(self, rows: DataFrame) -> DataFrame:
        """Digest of the ids that end at each node. Ids are joined block by block, then hashed piece by piece."""
        blocks = Blocks(rows.select(*KEY, "conv_id"), KEY, ["conv_id"], label="trie-ends").df
        pieces = blocks.groupBy(*KEY, "_block").agg(F.array_sort(F.collect_list("conv_id")).alias("ids"))
        pieces = pieces.select(*KEY, F.col("_block"), F.array_join(F.col("ids").cast("array<string>"), ",").alias("piece"))
        return (pieces.repartition(*KEY).sortWithinPartitions(*KEY, "_block").select(*KEY, "piece")
                .mapInArrow(_digest_ends, "x1 long, x2 long, depth long, ends_sha256 string"))

    def nodes(self) -> DataFrame:
        """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256; one row per node."""
        found, convs = self.prefixes()
        rows = staged(self.screened(staged(found, "trie-prefixes", rows=10_000)), "trie-screened", rows=10_000)
        one = convs.agg(F.min("conv_id").alias("least"), F.count("*").alias("n")).first()
        long = lambda x: F.lit(x).cast("long")
        root_id = long(one["least"])
        tail = rows.where("NOT shared AND NOT after_shared").select(
            "conv_id", "depth", F.when(F.col("depth") == 1, root_id).otherwise(F.col("conv_id")).alias("parent_conv_id"),
            long(1).alias("n_convs"), F.when(F.col("last"), long(0)).otherwise(long(1)).alias("n_children"), long(1).alias("n_leaves"),
            long(0).alias("saved_tokens"),
            F.when(F.col("last"), F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)).otherwise(F.lit(NO_ENDS)).alias("ends_sha256"))
        exact = rows.where("shared OR after_shared")
        groups = exact.groupBy(*KEY).agg(F.min("conv_id").alias("owner"), F.count("*").alias("n"), F.max(~F.col("last")).alias("goes_on"))
        own = F.col("conv_id") == F.col("owner")
        member = exact.join(groups, KEY).withColumns({
            "saves": F.when(own, (F.col("n") - 1) * F.col("chars")).otherwise(long(0)),
            "ends_leaf": F.when(F.col("last"), F.when(own & ~F.col("goes_on"), long(1)).otherwise(long(0))), "up": -F.col("depth")})
        member = Blocks(member, ["conv_id"], ["up"], label="trie-members").running(
            below=("sum", "saves"), totals={"leaf": ("max", "ends_leaf")}).rows()
        # the end of a conversation without a row here was proven single: a leaf
        nodes = member.groupBy(*KEY).agg(
            F.min("owner").alias("conv_id"), F.min("n").alias("n_convs"), F.max("goes_on").alias("goes_on"), F.min("y1").alias("y1"),
            F.min("y2").alias("y2"), F.max("shared").alias("shared"), F.sum("below").alias("saved_tokens"),
            F.sum(F.coalesce("leaf", long(1))).alias("n_leaves"), F.sum("saves").alias("own_saving"))
        nodes = staged(nodes, "trie-nodes", rows=10_000)
        parents = nodes.select(F.col("x1").alias("y1"), F.col("x2").alias("y2"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("above"))
        children = nodes.groupBy(F.col("y1").alias("x1"), F.col("y2").alias("x2"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("born"))
        ended = self.ends(exact.where("last"))
        full = nodes.join(parents, ["y1", "y2", "depth"], "left").join(children, KEY, "left").join(ended, KEY, "left").select(
            "conv_id", "depth", F.when(F.col("depth") == 1, root_id).otherwise(F.coalesce("above", "conv_id")).alias("parent_conv_id"), "n_convs",
            F.when(F.col("shared"), F.coalesce("born", long(0))).otherwise(F.col("goes_on").cast("long")).alias("n_children"), "n_leaves",
            "saved_tokens", F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"))
        below = staged(full.union(tail), "trie-below", rows=10_000)
        return below.union(self._root(below, nodes, convs, root_id))

    def _root(self, below, nodes, convs, root_id) -> DataFrame:
        """The textless root, if there is any conversation. Its digest is zero, its members are all conversations."""
        zero = F.lit(0).cast("long")
        ended = self.ends(convs.where("total = 0").select(zero.alias("x1"), zero.alias("x2"), zero.alias("depth"), "conv_id")).select("ends_sha256")
        sums = below.agg(F.coalesce(F.sum((F.col("depth") == 1).cast("long")), zero).alias("n_children"),
                         F.greatest(F.coalesce(F.sum((F.col("n_children") == 0).cast("long")), zero), F.lit(1)).alias("n_leaves"))
        saved = nodes.agg(F.coalesce(F.sum("own_saving"), zero).alias("saved_tokens"))
        members = convs.agg(F.count("*").alias("n_convs"), F.max("total").alias("longest")).where("n_convs > 0")
        one_row = members.unionByName(sums, True).unionByName(saved, True).unionByName(ended, True)  # each has one row at most
        one_row = one_row.agg(*[F.max(c).alias(c) for c in one_row.columns]).where("n_convs > 0")
        return one_row.select(
            root_id.alias("conv_id"), zero.alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
            "saved_tokens", F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"))


def prefix_trie(turns: DataFrame, **options) -> DataFrame:
    return PrefixTrie(turns, **options).nodes()
