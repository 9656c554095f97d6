"""Benchmark decontamination by a positional inverted index, in DataFrame operations only.

1. Every word of the documents that occurs in the test items becomes a posting (term, document, position), stored in the
   shared folder in document order.
2. Posting counts tell how rare each term is. Each window of an item is looked up by its two rarest terms: their lists,
   shifted by the place of the term in the item, meet on (document, item, shift).
3. Documents on which a window's lists meet are compared with the item word by word; this gives the exact passages.

Only the terms of the items are broadcast, in blocks of items whose number of terms is counted first. Texts move once, in
the join of step 3, by a key that no two different documents share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import ascii_lower, staged

#: Between words. Before and after A-Z are lower-cased, a text is cut alike.
BREAK = r"[^0-9A-Za-z\x{80}-\x{10FFFF}]+"
KEY = ["doc_id", "rk"]


def cut(text: Column) -> Column:
    """The words of a text, and an empty one after them if something else ends it."""
    return F.split(F.regexp_replace(F.coalesce(text, F.lit("")), f"^{BREAK}", ""), BREAK)


def once(value: Column, use) -> Column:
    """``use`` of a value that is computed once; an alias could be put in place of each use, inside loops too."""
    return F.transform(F.array(value), use)[0]


def number_of(text: Column) -> Column:
    return once(cut(text), lambda words: (F.size(words) - (F.element_at(words, -1) == "").cast("int")).cast("long"))


class TestItemIndex:
    """Occurrences of test items in documents: all runs of ``window`` consecutive item words, or of the whole shorter item.

    Rows of documents are known by id and text, so repeated rows share one result; null ids and texts are allowed. Null and
    empty items match nothing. Equal rows of items count once; an item without an id marks words but is not listed.
    """

    def __init__(self, docs: DataFrame, items: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text: str = "text", block: int = 200_000):
        self.window, self.text_col = window, text_col
        self.docs = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("rk"))
        words = F.filter(cut(ascii_lower(F.col(item_text))), lambda w: w != "")
        items = items.select(F.col(item_col).cast("string").alias("item_id"), words.alias("words")).where(F.size("words") > 0)
        self.items = staged(items.distinct().withColumn("item", F.monotonically_increasing_id()), "decon-items")
        terms = self.items.select(F.sum(F.size("words"))).first()[0] or 0
        self.blocks = max(1, -(-terms // block))

    def _block(self, k: int) -> DataFrame:
        return self.items.where(F.pmod(F.xxhash64("item"), F.lit(self.blocks)) == k)

    def places(self, items: DataFrame) -> DataFrame:
        return items.select("item", F.posexplode("words").alias("j", "word")).select("item", "j", F.lower("word").alias("term"))

    def postings(self, items: DataFrame) -> DataFrame:
        """(term, doc_id, rk, pos) of every document word that is a term of ``items``. Terms are lower-cased one by one, which is
        coarser than A-Z alone; the comparison of step 3 is exact."""
        terms = self.places(items).select("term").distinct()
        words = self.docs.select(*KEY, F.posexplode(cut(F.col("row")[self.text_col])).alias("pos", "word"))
        words = words.select(*KEY, "pos", F.lower("word").alias("term"))
        return staged(words.join(F.broadcast(terms), "term", "left_semi"), "decon-postings")

    def anchors(self, items: DataFrame, postings: DataFrame) -> DataFrame:
        """Per item the distinct pairs (j1, j2) of places of the two rarest terms of its windows; windows with an absent term go."""
        counts = postings.groupBy("term").agg(F.count("*").alias("n"))
        known = (self.places(items).join(counts, "term", "left").groupBy("item")
                 .agg(F.array_sort(F.collect_list(F.struct("j", F.coalesce("n", F.lit(0)).alias("n")))).alias("at")))
        length = F.least(F.lit(self.window), F.size("at"))
        windows = known.select("item", "at", length.alias("length"), F.explode(F.sequence(F.lit(0), F.size("at") - length)).alias("o"))
        rare = F.array_sort(F.transform(F.slice("at", F.col("o") + 1, F.col("length")), lambda x: F.struct(x["n"].alias("n"), x["j"].alias("j"))))
        windows = windows.select("item", rare.alias("rare")).where(F.col("rare")[0]["n"] > 0)
        pairs = windows.select("item", F.struct(F.col("rare")[0]["j"].alias("j1"), F.coalesce(F.get("rare", F.lit(1))["j"], F.col("rare")[0]["j"]).alias("j2")).alias("p"))
        return staged(pairs.groupBy("item").agg(F.collect_set("p").alias("pairs")), "decon-anchors")

    def meetings(self, items: DataFrame, postings: DataFrame) -> DataFrame:
        """(doc_id, rk, item, shift) on which the shifted lists of a window's two rarest terms meet."""
        anchors = self.anchors(items, postings)
        used = anchors.select("item", F.explode("pairs").alias("p")).select("item", F.explode(F.array("p.j1", "p.j2")).alias("j")).distinct()
        wanted = self.places(items).join(used, ["item", "j"]).groupBy("term").agg(F.collect_list(F.struct("item", "j")).alias("uses"))
        lists = postings.join(F.broadcast(wanted), "term").select(*KEY, "pos", F.explode("uses").alias("use"))
        met = (lists.groupBy(*KEY, F.col("use.item").alias("item"), (F.col("pos") - F.col("use.j")).alias("shift"))
               .agg(F.collect_set("use.j").alias("js")).join(F.broadcast(anchors), "item"))
        return met.where(F.exists("pairs", lambda p: F.array_contains("js", p["j1"]) & F.array_contains("js", p["j2"]))).select(*KEY, "item", "shift")

    def proximity(self, slop: int) -> DataFrame:
        """(doc_id, item_id, pos): places where two rarest terms of a window of the item stand within ``slop`` words of their
        distance in the item, whatever lies between."""
        found = []
        for k in range(self.blocks):
            items = self._block(k)
            postings = self.postings(items)
            pairs = self.anchors(items, postings).select("item", F.explode("pairs").alias("p")).select("item", "p.j1", "p.j2")
            places = self.places(items)
            for j in ("j1", "j2"):
                pairs = pairs.join(places.select("item", F.col("j").alias(j), F.col("term").alias(f"t{j}")), ["item", j])
            left = postings.join(F.broadcast(pairs), postings.term == pairs.tj1).select(
                *KEY, "item", "tj2", "pos", (F.col("j2") - F.col("j1")).alias("gap"))
            # Places are met in cells a little wider than the slop, so that a frequent term meets its neighbourhood only.
            cell = 2 * slop + 1
            aim = F.col("pos") + F.col("gap")
            left = left.withColumn("cell", F.explode(F.array_distinct(F.array(F.floor((aim - slop) / cell), F.floor((aim + slop) / cell)))))
            right = postings.select(*(F.col(c).alias(f"r_{c}") for c in KEY), F.col("term").alias("tj2"), F.col("pos").alias("r_pos"),
                                    F.floor(F.col("pos") / cell).alias("cell"))
            near = left.join(right, ["tj2", "cell"]).where(F.col("doc_id").eqNullSafe(F.col("r_doc_id")) & (F.col("rk") == F.col("r_rk")))
            near = near.where(F.abs(F.col("r_pos") - F.col("pos") - F.col("gap")) <= slop)
            found.append(near.join(items.select("item", "item_id"), "item").select("doc_id", "item_id", "pos").distinct())
        return _union(found)

    def occurrences(self) -> DataFrame:
        """Every row of the documents (struct ``row``) with its number of words and its exact passages: an array of
        (item_id, start, length), counted in words."""
        met = []
        for k in range(self.blocks):
            items = self._block(k)
            found = self.meetings(items, self.postings(items)).join(items, "item")
            met.append(found.select(*KEY, F.struct("item_id", "shift", "words").alias("c")))
        cases = _union(met).groupBy(*KEY).agg(F.collect_list("c").alias("cases"))
        cases = cases.select(F.col("doc_id").alias("c_id"), F.col("rk").alias("c_rk"), "cases")
        same = F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("rk") == F.col("c_rk"))
        text = F.col("row")[self.text_col]
        rows = self.docs.join(cases.hint("shuffle_hash"), same, "left")

        def passages(words, case):
            length = F.least(F.lit(self.window), F.size(case["words"]))
            starts = F.filter(F.sequence(F.lit(0), F.size(case["words"]) - length), lambda o: (case["shift"] + o >= 0) & (F.transform(
                F.slice(words, F.greatest(case["shift"] + o + 1, F.lit(1)), length), ascii_lower) == F.slice(case["words"], o + 1, length)))
            return F.transform(starts, lambda o: F.struct(
                case["item_id"].alias("item_id"), (case["shift"] + o).alias("start"), length.alias("length")))

        found = F.when(F.col("cases").isNull(), F.array()).otherwise(once(cut(text), lambda words: F.flatten(
            F.transform("cases", lambda case: passages(words, case)))))
        return rows.select("row", "doc_id", number_of(text).alias("n_words"),
                           found.cast("array<struct<item_id:string,start:int,length:int>>").alias("passages"))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def clean_documents(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that hold no passage of an item, with all their columns."""
    return TestItemIndex(docs, items, **options).occurrences().where(F.size("passages") == 0).select("row.*")
