"""Spelling variants: words one edit apart, found in a trie of letter-group counts.

1. Words and their numbers of occurrences come from one partial aggregation over all texts.
2. A word is arranged by how many of its letters fall into each of 16 groups, one level of the trie per group. One edit changes at
   most one count by +1 and one by -1, so a search that may spend one surplus and one deficit on its way down meets all words
   one edit away. Words at the leaves it reaches are compared letter by letter.
3. The trie is cut below its first levels, where subtrees become small enough. A word lies in one subtree and is asked for there and
   in each later subtree that its budget reaches; what it meets in a later one counts for both words. Subtrees are cut into cells of
   bounded size, and each cell is searched in one task, for blocks of words at a time. A cell returns one row per word: the number of
   near words and the best of them; pairs are never rows.
4. Forms are followed to the last by doubling, in as many rounds as the logarithm of the longest chain.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import ascii_lower, staged

RUN = "[A-Za-zÀ-ÿ]+"
GROUPS = 16
BLOCK = 2048  # different count vectors searched together
PAIRS = 1 << 20  # words compared together
WIDE = 64  # longer words are compared one by one


def letters_of(group: int) -> str:
    """Code points of a group: every sixteenth letter in code-point order."""
    return "".join(chr(c) for c in (*range(97, 123), *range(0xC0, 0x100)) if c % GROUPS == group)


def steps(levels: int) -> list[list[int]]:
    """What a budget of one surplus and one deficit may change over the first ``levels`` counts; no change comes first."""
    out = [[0] * levels]
    for up in (*range(levels), None):
        for down in (*range(levels), None):
            if up != down:
                out.append([(i == up) - (i == down) for i in range(levels)])
    return out


class Words:
    """Words of one Arrow column as Latin-1 codes, with their count vectors sorted and the words of equal vectors together."""

    def __init__(self, words, n):
        plain = [w.encode("latin-1") for w in words.to_pylist()]
        size = np.array([len(w) for w in plain], np.int64)
        flat = np.frombuffer(b"".join(plain), np.uint8)
        owner = np.repeat(np.arange(len(plain)), size)
        counts = np.bincount(owner * GROUPS + flat % GROUPS, minlength=len(plain) * GROUPS).reshape(-1, GROUPS)
        order = np.lexsort(counts.T[::-1])
        self.plain, self.size, self.n = [plain[i] for i in order], size[order], n[order]
        counts = counts[order]
        fresh = np.concatenate([[True], (counts[1:] != counts[:-1]).any(axis=1)]) if len(counts) else np.zeros(0, bool)
        self.first = np.append(np.flatnonzero(fresh), len(counts))  # words first[i]:first[i + 1] have vector i
        self.vectors = counts[fresh]
        self.codes = np.zeros((len(plain), WIDE), np.uint8)
        narrow = np.flatnonzero(self.size <= WIDE)
        at = np.concatenate([[0], np.cumsum(self.size)])
        joined = np.frombuffer(b"".join(self.plain), np.uint8)
        rows = np.repeat(narrow, self.size[narrow])
        places = np.arange(len(rows)) - np.repeat(np.cumsum(self.size[narrow]) - self.size[narrow], self.size[narrow])
        self.codes[rows, places] = joined[at[rows] + places]


def _levels(vectors: np.ndarray) -> tuple[list[np.ndarray], int]:
    """The trie of sorted vectors: for each level, sorted (node above, count) keys; a node's number is its key's place."""
    base = int(vectors.max(initial=0)) + 3
    levels, above = [], np.zeros(len(vectors), np.int64)
    for i in range(vectors.shape[1]):
        keys, place = np.unique(above * base + vectors[:, i], return_inverse=True)
        levels.append(keys)
        above = place.ravel()
    return levels, base


def _reached(asked: np.ndarray, levels, base: int) -> tuple[np.ndarray, np.ndarray]:
    """(asked vector, leaf) of all leaves within one surplus and one deficit."""
    who, node = np.arange(len(asked)), np.zeros(len(asked), np.int64)
    more, less = np.zeros(len(asked), bool), np.zeros(len(asked), bool)
    for i, keys in enumerate(levels):
        count = asked[who, i]
        ways = []
        for change, free in ((0, None), (1, ~more), (-1, ~less)):
            rows = np.arange(len(who)) if free is None else np.flatnonzero(free)
            want = count[rows] - change
            good = (want >= 0) & (want < base)
            rows, key = rows[good], (node[rows] * base + want)[good]
            place = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            hit = keys[place] == key
            rows, place = rows[hit], place[hit]
            ways.append((who[rows], place, more[rows] | (change == 1), less[rows] | (change == -1)))
        who, node, more, less = (np.concatenate(x) for x in zip(*ways))
    return who, node


def _one_edit(a: Words, x: np.ndarray, b: Words, y: np.ndarray) -> np.ndarray:
    """Whether words x of ``a`` and y of ``b`` differ by exactly one inserted, deleted or replaced letter."""
    out = np.zeros(len(x), bool)
    apart = a.size[x] - b.size[y]
    narrow = (a.size[x] <= WIDE) & (b.size[y] <= WIDE)
    same = np.flatnonzero(narrow & (apart == 0))
    width = int(a.size[x[same]].max(initial=0))
    out[same] = (a.codes[x[same], :width] != b.codes[y[same], :width]).sum(axis=1) == 1
    for side, (p, i, q, j) in ((1, (a, x, b, y)), (-1, (b, y, a, x))):
        rows = np.flatnonzero(narrow & (apart == side))
        width = int(p.size[i[rows]].max(initial=1))
        long, short = p.codes[i[rows], :width], q.codes[j[rows], : width - 1]
        apart_at = np.cumsum(long[:, :-1] != short, axis=1)  # 0 as far as both begin alike
        again = (long[:, 1:] != short)[:, ::-1].cumsum(axis=1)[:, ::-1]  # 0 from where on they end alike, one place on
        before = np.concatenate([np.zeros((len(rows), 1), int), apart_at], axis=1)
        after = np.concatenate([again, np.zeros((len(rows), 1), int)], axis=1)
        out[rows] = ((before == 0) & (after == 0)).any(axis=1)
    for k in np.flatnonzero(~narrow & (np.abs(apart) <= 1)).tolist():
        p, q = a.plain[x[k]], b.plain[y[k]]
        if len(p) < len(q):
            p, q = q, p
        i = next((i for i, (s, t) in enumerate(zip(p, q)) if s != t), len(q))
        out[k] = p != q and p[i + 1 :] == (q[i + 1 :] if len(p) == len(q) else q[i:])
    return out


def _expand(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, value) for all values of the ranges first[row]:last[row]."""
    size = last - first
    row = np.repeat(np.arange(len(size)), size)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size) + first[row]


class Best:
    """For each word of one side: number of near words, and the place of the most frequent one of the other side (ties: the smallest)."""

    def __init__(self, own: Words, other: Words):
        self.near = np.zeros(len(own.n), np.int64)
        self.liked = np.array(sorted(range(len(other.n)), key=lambda i: (-other.n[i], other.plain[i])), np.int64)
        self.rank = np.empty(len(self.liked), np.int64)
        self.rank[self.liked] = np.arange(len(self.liked))
        self.top = np.full(len(own.n), len(self.liked), np.int64)
        self.own, self.other = own, other

    def meet(self, x: np.ndarray, y: np.ndarray) -> None:
        self.near += np.bincount(x, minlength=len(self.near))
        np.minimum.at(self.top, x, self.rank[y])

    def rows(self) -> list[tuple]:
        return [(self.own.plain[i].decode("latin-1"), int(self.near[i]), self.other.plain[j].decode("latin-1"), int(self.other.n[j]))
                for i in np.flatnonzero(self.near).tolist() for j in (self.liked[self.top[i]],)]


def search(asked: Words, trie: Words):
    """(x, y): places of asked words and of words of the trie one edit apart, some at a time."""
    if not len(asked.n) or not len(trie.n):
        return
    levels, base = _levels(trie.vectors)
    for at in range(0, len(asked.vectors), BLOCK):
        who, leaf = _reached(asked.vectors[at : at + BLOCK], levels, base)
        who = who + at
        pairs = np.cumsum((asked.first[who + 1] - asked.first[who]) * (trie.first[leaf + 1] - trie.first[leaf]))
        start = 0
        while start < len(who):
            end = max(start + 1, int(np.searchsorted(pairs, (pairs[start - 1] if start else 0) + PAIRS, side="right")))
            row, x = _expand(asked.first[who[start:end]], asked.first[who[start:end] + 1])
            leaves = leaf[start:end][row]
            for part in range(0, len(x), BLOCK * 16):  # words of one vector may be many
                some = slice(part, part + BLOCK * 16)
                pick, y = _expand(trie.first[leaves[some]], trie.first[leaves[some] + 1])
                xs = x[some][pick]
                hit = _one_edit(asked, xs, trie, y)
                yield xs[hit], y[hit]
            start = end


def _search_cell(asked, trie):
    """Words asked from the trie's own subtree get what they meet; with words from earlier subtrees both sides do."""
    out, inside = [], asked.column("a_inside").to_numpy(zero_copy_only=False)
    trie = Words(trie.column("t_word"), trie.column("t_n").to_numpy())
    for own in (True, False):
        some = asked.filter(pa.array(inside == own))
        words = Words(some.column("a_word"), some.column("a_n").to_numpy())
        here, there = Best(words, trie), Best(trie, words)
        for x, y in search(words, trie):
            here.meet(x, y)
            if not own:
                there.meet(y, x)
        out += here.rows() + there.rows()
    names = ["word", "near", "best", "best_n"]
    columns = list(zip(*out)) or [()] * 4
    return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.string(), pa.int64()))], names=names)


class SpellingVariants:
    """Words of ``docs`` and the forms they are variants of.

    A word is a maximal run of Latin letters, A-Z lower-cased, of at least ``length`` letters and ``least`` occurrences in all
    rows. Repeated rows count each. Null and empty texts have no words. ``damage`` deletes one letter of every word
    whose crc32 of "id:word" it divides, to plant variants; rows without an id are left as they are. A word's form is its
    most frequent near word if that is ``factor`` times as frequent, ties by code points. Extra columns are ignored.
    """

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 5, least: int = 3, factor: int = 2,
                 damage: int | None = None, cell: int = 50_000):
        self.length, self.least, self.factor, self.damage, self.cell = length, least, factor, damage, cell
        self.docs = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def words(self) -> DataFrame:
        """(word, n)."""
        runs = self.docs.select("doc_id", F.explode(F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(RUN), F.lit(0))).alias("run"))
        word = F.col("run")
        if self.damage:
            runs = runs.withColumn("h", F.crc32(F.concat("doc_id", F.lit(":"), "run")))
            at = F.col("h") % F.length("run")
            cut = F.concat(F.substring("run", F.lit(1), at.cast("int")), F.substring("run", (at + 2).cast("int"), F.length("run")))
            word = F.when(F.col("h") % self.damage == 0, cut).otherwise(F.col("run"))
        long = runs.select(word.alias("word")).where(F.length("word") >= self.length)
        return long.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= self.least)

    def _arranged(self, words: DataFrame) -> DataFrame:
        counts = [F.length("word") - F.length(F.translate("word", letters_of(g), "")) for g in range(GROUPS)]
        return words.select("word", "n", F.array(*counts).alias("v"))

    def near(self, words: DataFrame) -> DataFrame:
        """(word, n_near, best, best_n) of words with near words."""
        words = staged(self._arranged(words), "spelling-vectors")
        levels = 4
        while True:
            path = F.slice("v", 1, levels)
            trees = words.groupBy(path.alias("path")).agg(F.count("*").alias("m"))
            trees = staged(trees.withColumn("to", F.monotonically_increasing_id()), "spelling-subtrees")
            if levels == GROUPS or (trees.agg(F.max("m")).first()[0] or 0) <= self.cell:
                break
            levels += 2
        # between two subtrees the earlier one's words ask: a step to a later path begins with a surplus
        ways = [s for s in steps(levels) if next((x for x in s if x), 1) > 0]
        there = trees.select(F.col("path").alias("there"), "to", F.ceil(F.col("m") / self.cell).cast("int").alias("trees"))
        moved = F.transform(F.array(*[F.array(*map(F.lit, s)) for s in ways]), lambda s: F.zip_with("path", s, lambda a, b: a + b))
        routes = staged(trees.select("path", "m", F.explode(moved).alias("there")).join(there, "there").select(
            "path", "m", "to", "trees", (F.col("path") == F.col("there")).alias("inside")), "spelling-routes")
        askers = routes.groupBy("to").agg(F.ceil(F.sum("m") / self.cell).cast("int").alias("askers"))
        # at most one element per way
        asking = routes.join(askers, "to").groupBy("path").agg(F.collect_list(F.struct("to", "trees", "askers", "inside")).alias("ways"))
        holding = there.join(askers, "to").select(F.col("there").alias("path"), "to", "trees", "askers")
        placed = words.select("word", "n", path.alias("path"))

        def dealt(rows, side, own, other):
            """Each row in one cell of its own side, repeated for each of the other's; grouped by cell."""
            place = F.pmod(F.xxhash64("word"), F.col(own).cast("long")).cast("int")
            rest = [c for c in ("word", "n", "to", "inside") if c in rows.columns]
            cells = rows.select(*[F.col(c).alias(f"{side}_{c}") for c in rest], place.alias(f"{side}_{own}"),
                                F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(f"{side}_{other}"))
            return cells.groupBy(f"{side}_to", f"{side}_askers", f"{side}_trees")

        left = dealt(placed.join(asking, "path").select("word", "n", F.explode("ways").alias("w")).select("word", "n", "w.*"), "a", "askers", "trees")
        right = dealt(placed.join(holding, "path"), "t", "trees", "askers")
        found = left.cogroup(right).applyInArrow(_search_cell, "word string, near long, best string, best_n long")
        best = F.min(F.struct((-F.col("best_n")).alias("less"), "best"))
        merged = found.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("b"))
        return merged.select("word", "n_near", F.col("b.best").alias("best"), (-F.col("b.less")).alias("best_n"))

    def roots(self, forms: DataFrame) -> DataFrame:
        """(word, root) of words with a form, the form's form and so on followed to the last. Frequencies grow along the way."""
        at = staged(forms.select("word", F.col("form").alias("root")), "spelling-roots")
        while True:
            further = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
            moved = at.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
            moved = staged(moved, "spelling-roots")
            at = moved.select("word", "root")
            if moved.where("moved").isEmpty():
                return at

    def variants(self) -> DataFrame:
        """word, n, n_near, form, form_n, root; one row per word."""
        words = staged(self.words(), "spelling-words")
        near = self.near(words)
        is_form = F.col("best_n") >= F.col("n") * self.factor
        formed = staged(words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(is_form, F.col("best")).alias("form"),
            F.when(is_form, F.col("best_n")).alias("form_n")), "spelling-forms")
        roots = self.roots(formed.where("form IS NOT NULL"))
        return formed.join(roots, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def spelling_variants(docs: DataFrame, **options) -> DataFrame:
    return SpellingVariants(docs, **options).variants()
