"""Sharding by a permutation-filled lookup table, in DataFrame operations only.

Every shard has an own preference order over the slots of a table of prime size (an offset and a step, both hashed from its
name). Shards take turns, each claiming the first free slot it prefers, until the table is full: shards differ by one slot at
most, and taking a shard away moves little more than its own slots. A row's slot is a hash of its key; the table is
broadcast, its size being a parameter, and placing a row is one lookup without a shuffle.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SHARDS, SLOTS = 32, 2503


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16)


def fill_table(names: list[str], slots: int = SLOTS) -> list[int]:
    """The shard (by place in ``names``) of each slot; ``slots`` must be prime, so that every step visits all slots."""
    if len(set(names)) != len(names) or not 0 < len(names) <= slots:
        raise ValueError("shards need different names and at least one slot each")
    if slots < 2 or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError(f"{slots} slots: the number must be prime")
    at = [_number(f"offset:{x}") % slots for x in names]
    step = [_number(f"step:{x}") % (slots - 1) + 1 for x in names]
    table, free = [-1] * slots, slots
    while free:
        for shard in range(len(names)):
            while table[at[shard]] >= 0:
                at[shard] = (at[shard] + step[shard]) % slots
            table[at[shard]] = shard
            free -= 1
            if not free:
                break
    return table


def lookup(spark: SparkSession, names: list[str], slots: int = SLOTS) -> DataFrame:
    """(slot, shard): the filled table as rows."""
    filled = F.split(F.lit(",".join(map(str, fill_table(names, slots)))), ",")
    return spark.range(1).select(F.posexplode(filled).alias("slot", "shard")).select("slot", F.col("shard").cast("int").alias("shard"))


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    return (F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("long") % slots).cast("int")


def shard_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The id as text; rows without an id go by their text, so that they spread, and rows without either share one slot."""
    return F.coalesce(F.concat(F.lit("i"), F.col(id_col).cast("string")), F.concat(F.lit("t"), F.col(text_col).cast("string")), F.lit(""))


def place(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, key: Column | None = None, shard_col: str = "shard") -> DataFrame:
    """``docs`` with a shard from 0 to ``shards`` - 1 for every row; equal keys share a shard. A column that is already called
    ``shard_col`` is replaced."""
    table = lookup(docs.sparkSession, [f"shard-{i}" for i in range(shards)], slots)
    rows = docs.select(F.struct("*").alias("row"), slot_of(key if key is not None else shard_key(), slots).alias("slot"))
    rows = rows.join(F.broadcast(table), "slot")
    return rows.select(*(F.col("row")[c].alias(c) for c in docs.columns if c != shard_col), F.col("shard").alias(shard_col))


def write_shards(docs: DataFrame, path: str, shard_col: str = "shard", rows_per_file: int = 1_000_000) -> None:
    """One folder per shard. Tasks write what they hold, so that a large shard is not gathered in one task."""
    docs.write.option("maxRecordsPerFile", rows_per_file).partitionBy(shard_col).mode("errorifexists").parquet(path)
