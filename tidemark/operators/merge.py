"""Upsert with null-safe change detection, and the operators around it.

A merge is one lazy DataFrame holding the next version of the target plus an ``_action`` column
(``insert``, ``update`` or ``keep``). How the two sides meet depends on the sizes:

``shuffle``    one full outer join on the key; each side is shuffled once, and the source shares that shuffle
               with its deduplication.
``broadcast``  for a source far smaller than the target: the target streams past the source without being
               shuffled. Catalyst broadcasts only below ``spark.sql.autoBroadcastJoinThreshold``; no hint is
               given, so adaptive execution may still fall back to a shuffle.
``bloom``      for a source that is small beside the target but too large to be broadcast: only a filter of its keys
               is. Target rows whose key is surely not in the source pass by unshuffled; the few others meet the
               source in a full outer join. The target is read twice, once for each part.

Two kinds of rows stay out of that join because hashing would send them all to one task. Rows whose key holds
a null never match and are passed on; the filter sits on the key columns, hence reaches the scans, and costs
almost nothing when row group statistics show no nulls. Rows of hot keys (see :func:`hot_keys`), which a target
that was not loaded by key may hold, meet their few source rows in a broadcast join of their own.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.names import columns, quote
from tidemark.functions.rows import any_null, comparable, differs, order_key
from tidemark.functions.times import ntz
from tidemark.sinks.storage import scratch_path

INSERTED = "EDW_INSERTED_TIMESTAMP"
UPDATED = "EDW_UPDATED_TIMESTAMP"
ACTION = "_action"
MAYBE = "_maybe"
AUDIT_COLUMNS = (INSERTED, UPDATED)


def data_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in (*AUDIT_COLUMNS, ACTION)]


def with_stamps(df: DataFrame, inserted: str | None = None, updated: str | None = None) -> DataFrame:
    """Append the two audit columns with fixed values."""
    return df.withColumns({
        INSERTED: ntz(inserted) if inserted else F.lit(None).cast("timestamp_ntz"),
        UPDATED: ntz(updated) if updated else F.lit(None).cast("timestamp_ntz"),
    })


def merge(target: DataFrame, source: DataFrame, keys, stamp: str, strategy: str = "auto",
          null_keys: str = "insert", hot=(), newer_by=None) -> DataFrame:
    """Next version of ``target`` after upserting ``source`` (one row per key), with ``_action``.

    Matched and different: every data column is taken from the source, the update stamp is set, the insert
    stamp stays. Matched and equal, or only in the target: kept untouched. Only in the source: inserted.
    ``null_keys="reject"`` drops source rows whose key holds a null instead of inserting them at every run;
    ``"rare"`` gives the same rows as ``"insert"`` but lets them go through the join, which saves evaluating a
    computed key twice where such rows are few.
    ``hot`` lists key hashes from :func:`hot_keys`.
    ``newer_by`` = (insert column, update column) makes an update also need a time that is not older than the
    target row's, so that batches arriving out of order cannot undo each other.
    """
    if null_keys not in ("insert", "reject", "rare"):
        raise ValueError(f"null_keys must be 'insert', 'reject' or 'rare', not {null_keys!r}")
    names = data_columns(target)
    by_fold = {n.lower(): n for n in names}
    keys = [by_fold[k.lower()] for k in keys]
    source = _align(source, target, names)
    if strategy == "auto":
        strategy = choose_strategy(target, source)
    rules = _Rules(target, names, keys, stamp, newer_by)
    keyed_target, keyed_source, parts = target, source, []
    if null_keys != "rare":
        null, keyed = any_null(keys), "NOT " + any_null(keys)
        keyed_target, keyed_source = target.where(keyed), source.where(keyed)
        parts.append(rules.kept(target.where(null)))
        if null_keys == "insert":
            parts.append(rules.inserted(source.where(null)))
    if hot:
        is_hot = key_hash(keys).isin(list(hot))
        parts.append(rules.left_then_insert(keyed_target.where(is_hot), F.broadcast(keyed_source.where(is_hot))))
        keyed_target, keyed_source = keyed_target.where(~is_hot), keyed_source.where(~is_hot)
    asked = key_filter(keyed_source, keys) if strategy == "bloom" else None
    if asked is not None:
        maybe = asked.mark(keyed_target, keys)
        parts.append(rules.kept(maybe.where(~F.col(MAYBE)).drop(MAYBE)))
        merged = rules.full_outer(maybe.where(MAYBE).drop(MAYBE), keyed_source)
    elif strategy in ("shuffle", "bloom"):
        merged = rules.full_outer(keyed_target, keyed_source)
    elif strategy == "broadcast":
        merged = rules.left_then_insert(keyed_target, keyed_source)
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    return reduce(DataFrame.unionAll, parts, merged)


class KeyFilter:
    """A Bloom filter of keys as 64-bit words: a key sets three bits of one word, so that asking for a key is one lookup.

    ``words`` has one row (word, bits) per word in use, at most ``size`` of them.
    """

    def __init__(self, words: DataFrame, size: int):
        self.words, self.size = words, size

    @staticmethod
    def place(keys, size: int) -> tuple[Column, Column]:
        """The number of a key's word, and its bits in it."""
        where = F.pmod(key_hash(keys), F.lit(size).cast("long"))
        h = F.xxhash64(*columns(keys), F.lit("bits"))
        bits = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, n).bitwiseAND(F.lit(63)).cast("int")) for n in (0, 6, 12)]
        return where, bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2])

    def mark(self, df: DataFrame, keys) -> DataFrame:
        """``df`` with a column that is false where the key is surely not among those of the filter."""
        where, bits = self.place(keys, self.size)
        # bounded: see key_filter
        joined = df.withColumns({"_word": where, "_want": bits}).join(F.broadcast(self.words), "_word", "left")
        hit = F.coalesce(F.col("_bits").bitwiseAND(F.col("_want")) == F.col("_want"), F.lit(False))
        return joined.select(*columns(df.columns), hit.alias(MAYBE))


def key_filter(source: DataFrame, keys, per_word: int = 4, max_words: int = 1 << 20) -> KeyFilter | None:
    """Filter of the source's keys, its size following their number: ``per_word`` keys a word, which lets one strange key in
    some 200 pass. None where that takes more than ``max_words`` words (some 30 MB to broadcast).

    Counts the rows and writes the words once below the shared folder; the source should be a written table.
    """
    n = source.count()
    size = -(-n // per_word)
    if not 0 < size <= max_words:
        return None
    where, bits = KeyFilter.place(keys, size)
    words = source.select(where.alias("_word"), bits.alias("_bits")).groupBy("_word").agg(F.bit_or("_bits").alias("_bits"))
    path = scratch_path(source.sparkSession, "key-filter")
    words.write.parquet(path)
    return KeyFilter(source.sparkSession.read.parquet(path), size)


class _Rules:
    """The row rules of one merge, shared by the join strategies."""

    def __init__(self, target, names, keys, stamp, newer_by):
        self.names, self.keys, self.stamp, self.newer_by = names, list(keys), f"TIMESTAMP_NTZ '{stamp}'", newer_by
        self.types = {f.name: f.dataType for f in target.schema.fields}
        self.quoted = [quote(n) for n in names]

    def full_outer(self, target, source):
        return self._resolve(self._left(target).join(self._right(source), self._on(), "full_outer"))

    def left_then_insert(self, target, source):
        kept = self._resolve(self._left(target).join(self._right(source), self._on(), "left_outer"))
        keys = [quote(k) for k in self.keys]
        # distinct() collapses repeated keys map-side before they are shuffled
        present = target.selectExpr(*keys).join(source.selectExpr(*keys), self.keys, "left_semi").distinct()
        # inserts first: finding one takes a scan of the target's keys only (see has_changes)
        return self.inserted(source.join(present, self.keys, "left_anti")).unionAll(kept)

    def kept(self, target):
        return target.selectExpr(*self.quoted, INSERTED, UPDATED, f"'keep' AS {ACTION}")

    def inserted(self, source):
        return source.selectExpr(*self.quoted, f"{self.stamp} AS {INSERTED}",
                                 f"CAST(NULL AS TIMESTAMP_NTZ) AS {UPDATED}", f"'insert' AS {ACTION}")

    def _left(self, df):
        return df.selectExpr(*[f"{q} AS _t{i}" for i, q in enumerate(self.quoted)], INSERTED, UPDATED, "true AS _in_target")

    def _right(self, df):
        return df.selectExpr(*[f"{q} AS _s{i}" for i, q in enumerate(self.quoted)], "true AS _in_source")

    def _on(self):
        return F.expr(" AND ".join(f"_t{i} = _s{i}" for i in map(self.names.index, self.keys)))

    def _form(self, side, i, name) -> str:
        return comparable(f"{side}{i}", self.types[name])

    def _changed(self) -> str:
        rest = [(i, n) for i, n in enumerate(self.names) if n not in self.keys]
        if not rest:
            return "false"
        changed = differs([self._form("_s", i, n) for i, n in rest], [self._form("_t", i, n) for i, n in rest])
        if not self.newer_by:
            return changed
        at = {n.lower(): i for i, n in enumerate(self.names)}
        insert, update = [at[n.lower()] if n else None for n in self.newer_by]
        source, old = [order_key(None if update is None else f"{side}{update}", f"{side}{insert}") for side in ("_s", "_t")]
        return f"{changed} AND coalesce({source} >= {old}, true)"

    def _resolve(self, joined):
        decided = joined.selectExpr("*", f"""CASE WHEN _in_target IS NULL THEN 'insert' WHEN _in_source IS NULL THEN 'keep'
            WHEN {self._changed()} THEN 'update' ELSE 'keep' END AS {ACTION}""")
        return decided.selectExpr(
            *[f"IF({ACTION} = 'keep', _t{i}, _s{i}) AS {q}" for i, q in enumerate(self.quoted)],
            f"IF({ACTION} = 'insert', {self.stamp}, {INSERTED}) AS {INSERTED}",
            f"IF({ACTION} = 'update', {self.stamp}, {UPDATED}) AS {UPDATED}",
            ACTION,
        )


def _align(source: DataFrame, target: DataFrame, names) -> DataFrame:
    """Source columns in the target's order and types; names match without regard to case."""
    have = {c.lower(): c for c in source.columns}
    missing = [n for n in names if n.lower() not in have]
    if missing:
        raise ValueError(f"source lacks target columns {missing}; evolve the schema first")
    out = []
    for n in names:
        name, want = have[n.lower()], target.schema[n].dataType
        same = source.schema[name].dataType == want
        out.append(f"{quote(name)} AS {quote(n)}" if same else f"CAST({quote(name)} AS {want.simpleString()}) AS {quote(n)}")
    return source.selectExpr(*out)


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate; for a scan of written files it is their size."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def choose_strategy(target: DataFrame, source: DataFrame) -> str:
    """``broadcast`` when the source is below Spark's own limit and far below the target, ``bloom`` when only the latter and a
    written table, else ``shuffle``.

    The broadcast form reads the source three times and the target's keys twice, the bloom form the source three times and
    the target twice, so they must save a large shuffle. A bucketed target is not shuffled anyway.
    """
    limit = source.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = plan_bytes(source)
    if size * 16 > plan_bytes(target):
        return "shuffle"
    if size <= limit:
        return "broadcast"
    return "bloom" if limit >= 0 and source.inputFiles() and not bucketed(target) else "shuffle"


def bucketed(df: DataFrame) -> bool:
    """Whether a scan of ``df`` is clustered by buckets."""
    return "Bucketed: true" in df._jdf.queryExecution().executedPlan().toString()


def key_hash(keys) -> Column:
    return F.expr(f"xxhash64({', '.join(map(quote, keys))})")


def hot_keys(target: DataFrame, keys, share: float = 0.0005, floor: int = 100_000) -> list[int]:
    """Hashes of non-null keys that each hold more than ``share`` of the rows, and more than ``floor`` rows.

    One scan of the key columns. Each task leaves a sketch of fixed size; sketches meet in as many groups as
    there are shuffle partitions, then in one. The list cannot be longer than 1 / ``share``. It only decides how
    rows are joined, never which rows come out.
    """
    groups = int(target.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sketches = (
        target.where("NOT " + any_null(keys)).select(key_hash(keys).alias("k"))
        .groupBy(F.pmod(F.spark_partition_id(), F.lit(groups)).alias("g"))
        .agg(F.count(F.lit(1)).alias("rows"), F.expr("approx_top_k_accumulate(k, 8192)").alias("sketch"))
    )
    # grouped by a constant, because the sketches of an empty table cannot be combined
    row = sketches.groupBy(F.lit(1).alias("all")).agg(
        F.sum("rows").alias("rows"),
        F.expr(f"approx_top_k_estimate(approx_top_k_combine(sketch, 8192), {min(8192, int(1 / share))})").alias("top"),
    ).first()
    if row is None:
        return []
    return [e["item"] for e in row["top"] if e["count"] > max(floor, share * row["rows"])]


def has_changes(merged: DataFrame) -> bool:
    """Whether any row is inserted or updated; stops at the first one found."""
    return not merged.where(f"{ACTION} <> 'keep'").isEmpty()


def next_version(merged: DataFrame) -> DataFrame:
    return merged.drop(ACTION)


def action_counts(merged: DataFrame) -> DataFrame:
    """Rows per action. Partial aggregation leaves three rows per task to shuffle."""
    return merged.groupBy(F.col(ACTION).alias("action")).agg(F.count(F.lit(1)).alias("rows"))


def changed_keys(merged: DataFrame, keys) -> DataFrame:
    """Keys of inserted and updated rows, as a table rather than one text cell."""
    return merged.where(F.col(ACTION) != "keep").select(*columns(keys), F.col(ACTION).alias("kind"))


def changed_since_stamp(target: DataFrame, keys, stamp: str) -> DataFrame:
    """The same from a written target: rows stamped at or after ``stamp``. Both filters reach the scan."""
    at = ntz(stamp)
    return target.where((F.col(INSERTED) >= at) | (F.col(UPDATED) >= at)).select(
        *columns(keys), F.when(F.col(UPDATED) >= at, F.lit("update")).otherwise(F.lit("insert")).alias("kind"))


def delete_by_feed(target: DataFrame, feed: DataFrame, keys, hot=()) -> DataFrame:
    """Target rows whose key is not in the deletion feed.

    Joins on the key columns: concatenated keys make ('1','23') and ('12','3') meet. A null in the key
    matches nothing, so such rows bypass the join; rows of ``hot`` keys meet the feed in a broadcast join.
    """
    return _by_feed(target, feed, keys, hot, "left_anti").unionAll(target.where(any_null(keys)))


def deleted_rows(target: DataFrame, feed: DataFrame, keys, hot=()) -> DataFrame:
    """Target rows that the feed removes."""
    return _by_feed(target, feed, keys, hot, "left_semi")


def _by_feed(target, feed, keys, hot, how) -> DataFrame:
    """Rows with a whole key, by whether the feed has it. ``hot`` hashes bound the broadcast side."""
    keyed = "NOT " + any_null(keys)
    rows, gone = target.where(keyed), feed.select(*columns(keys)).where(keyed).distinct()

    def meet(left, right):
        return left.join(right, list(keys), how).select(*columns(target.columns))

    if not hot:
        return meet(rows, gone)
    is_hot = key_hash(keys).isin(list(hot))
    return meet(rows.where(~is_hot), gone.where(~is_hot)).unionAll(meet(rows.where(is_hot), F.broadcast(gone.where(is_hot))))


def master_refresh(source: DataFrame, stamp: str) -> DataFrame:
    """Target of a fully refreshed table: the deduplicated source, every row freshly inserted."""
    return with_stamps(source.select(*columns(data_columns(source))), stamp)
