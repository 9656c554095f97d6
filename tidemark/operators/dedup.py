"""Latest row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidemark.functions.names import quote
from tidemark.functions.rows import order_key, orderable


def latest_per_key(df: DataFrame, keys, insert_col: str | None, update_col: str | None = None,
                   tiebreak=None, nulls: str = "first") -> DataFrame:
    """Keep one row per key: the greatest update time, else insert time (no columns given: the tie-break alone).

    ``nulls="first"`` lets a row without any time win, as the warehouse's descending order does; ``"last"``
    lets it lose. ``tiebreak`` names columns (descending) that settle equal times; by default every other
    column takes part, so a recomputed task picks the same row.

    Spark limits each key to one row per map task before the shuffle (``WindowGroupLimit``), so a key that
    holds a large share of the rows, or a large group of null keys, reaches the reducer as one row per task.
    """
    order = []
    if insert_col:
        time = order_key(_moment(df, update_col) if update_col else None, _moment(df, insert_col))
        order = [f"{time} DESC NULLS {nulls.upper()}"]
    order += [f"{quote(n)} DESC NULLS FIRST" for n in _tiebreak(df, keys, tiebreak)]
    window = f"PARTITION BY {', '.join(map(quote, keys))} ORDER BY {', '.join(order)}"
    return df.selectExpr("*", f"row_number() OVER ({window}) AS _rank").where("_rank = 1").drop("_rank")


def best_key(df: DataFrame, keys, insert_col: str | None, update_col: str | None = None, tiebreak=None) -> Column:
    """A struct that is greatest for the row that :func:`latest_per_key` keeps, for aggregations such as ``max_by``."""
    time = [order_key(_moment(df, update_col) if update_col else None, _moment(df, insert_col))] if insert_col else []
    parts = [f"({x}) IS NULL, {x}" for x in (*time, *map(quote, _tiebreak(df, keys, tiebreak)))]
    return F.expr(f"struct({', '.join(parts)})")


def latest_document_per_key(df: DataFrame, key: Column, insert_time: Column, update_time: Column,
                            text: Column, nulls: str = "first") -> DataFrame:
    """The same for documents: key and times are expressions on the document, its text settles ties."""
    time = F.coalesce(update_time, insert_time)
    time = time.desc_nulls_first() if nulls == "first" else time.desc_nulls_last()
    rank = F.row_number().over(Window.partitionBy(key).orderBy(time, text.desc()))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def _moment(df: DataFrame, name: str) -> str:
    """Times kept as text are ordered as times; unreadable text counts as no time."""
    text = isinstance(df.schema[name].dataType, T.StringType)
    return f"try_cast({quote(name)} AS TIMESTAMP_NTZ)" if text else quote(name)


def _tiebreak(df: DataFrame, keys, given):
    if given is not None:
        return list(given)
    skip = {k.lower() for k in keys}
    return [f.name for f in df.schema.fields if f.name.lower() not in skip and orderable(f.dataType)]
