"""Differences between two snapshots of a table that has no modification time."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.functions.names import columns, quote
from tidemark.functions.rows import comparable, orderable, row_hash
from tidemark.operators.merge import delete_by_feed

_RUN = 10_000  # copies of one row emitted per intermediate row


def snapshot_diff(new: DataFrame, old: DataFrame) -> DataFrame:
    """Rows of ``new`` that no row of ``old`` equals in every column, nulls included; copies are kept.

    Both sides are tagged and grouped by their columns: one exact, null-safe pass in which copies of a row
    collapse before the shuffle, so a huge group of copies costs one row per task. An anti-join would bring
    all copies to one task. Copies are written out again at the end, dealt out to all tasks.
    """
    names = [quote(n) for n in new.columns]
    sides = [
        _groupable(df.selectExpr(*names)).selectExpr("*", f"CAST({1 - old} AS LONG) AS _new", f"{old} AS _old")
        for df, old in ((new, 0), (old, 1))
    ]
    groups = sides[0].unionAll(sides[1]).groupBy(*columns(new.columns)).agg(
        F.sum("_new").alias("_copies"), F.max("_old").alias("_known"))
    return _restore(expand_copies(groups.where("_known = 0").drop("_known"), "_copies"), new.schema)


def snapshot_deletes(new: DataFrame, old: DataFrame, keys) -> DataFrame:
    """Rows of ``old`` whose key is gone from ``new``. Null keys match nothing, so they count as gone."""
    return delete_by_feed(old, new, keys)


def hash_archive(snapshot: DataFrame) -> DataFrame:
    """What to keep of a snapshot when only hashes are archived."""
    rows = _groupable(snapshot)
    return rows.select(row_hash(rows).alias("hash_key")).distinct()


def snapshot_diff_by_hash(new: DataFrame, archive: DataFrame) -> DataFrame:
    """As :func:`snapshot_diff` against an archive of hashes. Copies collapse before the join here too."""
    groups = _groupable(new).groupBy(*columns(new.columns)).agg(F.count(F.lit(1)).alias("_copies"))
    groups = groups.withColumn("hash_key", row_hash(groups, new.columns))
    fresh = groups.join(archive.select("hash_key").distinct(), "hash_key", "left_anti").drop("hash_key")
    return _restore(expand_copies(fresh, "_copies"), new.schema)


def expand_copies(groups: DataFrame, copies: str) -> DataFrame:
    """One row per copy.

    Single rows pass through. Repeated ones are cut into runs, and the runs are dealt out evenly before they are
    written out; a shuffle sized by bytes would put them all into one task, as a run is one short row. Both branches
    read the same shuffle of the grouping.
    """
    n, names = quote(copies), [quote(c) for c in groups.columns if c != copies]
    tasks = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = (
        groups.where(f"{n} > 1")
        .selectExpr("*", f"explode(sequence(0L, CAST(floor(({n} - 1) / {_RUN}) AS LONG))) AS _run")
        .repartition(tasks)
        .selectExpr(*names, f"explode(array_repeat(true, CAST(least({_RUN}, {n} - _run * {_RUN}) AS INT))) AS _one")
        .drop("_one")
    )
    return groups.where(f"{n} = 1").selectExpr(*names).unionAll(runs)


def _groupable(df: DataFrame) -> DataFrame:
    """VARIANT and map columns cannot be grouped by; their comparable text or entry list can."""
    return df.selectExpr(*[f"{comparable(quote(f.name), f.dataType)} AS {quote(f.name)}" for f in df.schema.fields])


def _restore(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Back from the comparable form."""
    out = []
    for f in schema.fields:
        name = quote(f.name)
        if isinstance(f.dataType, T.VariantType):
            out.append(f"parse_json({name}) AS {name}")
        elif isinstance(f.dataType, T.MapType) and orderable(f.dataType.valueType):
            out.append(f"map_from_entries({name}) AS {name}")
        elif orderable(f.dataType):
            out.append(name)
        else:
            out.append(f"from_json({name}, 'v {f.dataType.simpleString()}').v AS {name}")
    return df.selectExpr(*out)
