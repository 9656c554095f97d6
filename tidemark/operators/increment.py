"""Watermarks: the last one from the control table, the rows past it, and the next one."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.names import column, columns
from tidemark.functions.times import DAY, LOOKBACK, MILLIS, ODATA_LOOKBACK, SENTINEL, coerce, ntz
from tidemark.operators.scan import Blocks


def changed_since(df: DataFrame, mark, insert_col: str, update_col: str | None = None) -> DataFrame:
    """Rows inserted or updated strictly after ``mark``; no mark means a full extract.

    A plain predicate on two columns, so it reaches Parquet and JDBC sources as a pushed filter.
    """
    if mark is None:
        return df
    late = _after(df, insert_col, mark)
    if update_col and update_col.lower() != insert_col.lower():
        late = late | _after(df, update_col, mark)
    return df.where(late)


def _after(df: DataFrame, name: str, mark) -> Column:
    """``name`` later than ``mark``. The mark takes the column's type, so that the column itself stays bare and
    the filter can be pushed; a date is later than a time when it is later than its day."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, (T.TimestampType, T.DateType)):
        return column(name) > as_mark(mark).cast(dtype)
    return moment(df, name) > as_mark(mark)


def moment(df: DataFrame, name: str) -> Column:
    """A time column as a zone-free timestamp; unreadable text is null."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.TimestampNTZType):
        return column(name)
    return coerce(column(name)) if isinstance(dtype, T.StringType) else column(name).cast("timestamp_ntz")


def deletes_since(feed: DataFrame, mark, keys, insert_col: str) -> DataFrame:
    """Keys and insert time of deletions logged after ``mark``."""
    return changed_since(feed.select(*columns(keys), column(insert_col)), mark, insert_col)


def as_mark(mark) -> Column:
    if isinstance(mark, Column):
        return mark
    return ntz(mark.isoformat(sep=" ") if isinstance(mark, datetime) else str(mark))


def usable_runs(control: DataFrame, need_rows: bool) -> DataFrame:
    """Successful runs with a real mark; file and OData sources also need inserted rows."""
    runs = control.where((F.col("STATUS") == "SUCCESS") & (F.col("MAX_TIMESTAMP") != ntz(SENTINEL)))
    return runs.where(F.col("ROWS_INSERTED") != 0) if need_rows else runs


def last_marks(control: DataFrame, by: str = "SOURCE_OBJECT_NAME", need_rows: bool = False) -> DataFrame:
    """Mark of the latest usable run of every object: one aggregation with map-side combine, no sort."""
    return usable_runs(control, need_rows).groupBy(F.col(by).alias("object")).agg(
        F.max_by("MAX_TIMESTAMP", "RUN_ID").alias("last_mark"))


def marks_as_of(control: DataFrame, by: str = "SOURCE_OBJECT_NAME", need_rows: bool = False) -> DataFrame:
    """(object, RUN_ID, mark): the mark in force for the object once each of its runs was logged, null before the first usable one.

    A scan in blocks, so that an object with most of the log is no single task. Runs without an object form one of their own.
    """
    usable = (F.col("STATUS") == "SUCCESS") & (F.col("MAX_TIMESTAMP") != ntz(SENTINEL))
    if need_rows:
        usable &= F.col("ROWS_INSERTED") != 0
    runs = control.select(F.col(by).alias("object"), "RUN_ID", F.when(usable, F.col("MAX_TIMESTAMP")).alias("_usable"))
    return Blocks(runs, ["object"], ["RUN_ID"], label="marks").running(mark=("last", "_usable")).rows().drop("_usable")


def last_marks_by_rule(control: DataFrame, rules: dict[str, tuple[str, bool]]) -> DataFrame:
    """(rule, object, last_mark) for several rules, each a name column and whether rows are needed, in one scan of the log."""
    cases = [F.when(F.lit(not need_rows) | (F.col("ROWS_INSERTED") != 0), F.struct(F.lit(rule).alias("rule"), F.col(by).alias("object")))
             for rule, (by, need_rows) in rules.items()]
    runs = usable_runs(control, need_rows=False).select("MAX_TIMESTAMP", "RUN_ID", F.explode(F.array(*cases)).alias("case"))
    marks = runs.where(F.col("case").isNotNull()).groupBy("case.rule", "case.object")
    return marks.agg(F.max_by("MAX_TIMESTAMP", "RUN_ID").alias("last_mark"))


class Marks:
    """The marks in force and the last run's number, read from the log once; runs logged later are noted here as well.

    Holds one entry per source object and one per target, whatever the length of the log.
    """

    RULES = {"SOURCE_OBJECT_NAME": ("SOURCE_OBJECT_NAME", False), "TARGET_TABLE_NAME": ("TARGET_TABLE_NAME", True)}

    def __init__(self, control: DataFrame):
        self.last_run = control.agg(F.max("RUN_ID").alias("r")).first()["r"] or 0
        found = last_marks_by_rule(control, self.RULES).collect()  # one row per object
        self._marks = {(r["rule"], r["object"]): r["last_mark"] for r in found}

    def get(self, name_col: str, name: str):
        return self._marks.get((name_col, name))

    def note(self, run: dict) -> None:
        """A run that has been logged, as a row of the control table."""
        self.last_run = max(self.last_run, run["RUN_ID"])
        mark = run["MAX_TIMESTAMP"]
        if run["STATUS"] != "SUCCESS" or mark is None or mark == datetime.fromisoformat(SENTINEL):
            return
        for rule, (by, need_rows) in self.RULES.items():
            if run["ROWS_INSERTED"] or not need_rows:
                self._marks[rule, run[by]] = mark


def last_mark(control: DataFrame | Marks, source: str, obj_type: str, source_object: str, target_table: str,
              lookback: timedelta | None = None):
    """Where the next incremental read of one object starts, or None for a full extract.

    File jobs look up their target (upper case) among runs that inserted rows and fall through to the
    source-object rule when there is none; OData jobs go by target with a lookback of two days, truncated
    to the day; all others go by source object with ten minutes. Given :class:`Marks`, nothing is read.
    """
    def lookup(name_col, name):
        if isinstance(control, Marks):
            return control.get(name_col, name)
        return usable_runs(control.where(F.col(name_col) == name), Marks.RULES[name_col][1]).agg(
            F.max_by("MAX_TIMESTAMP", "RUN_ID").alias("m")).first()["m"]

    if obj_type.lower() == "file":
        mark = lookup("TARGET_TABLE_NAME", target_table.upper())
        if mark is not None:
            return mark - (lookback or LOOKBACK)
    if source.lower() == "sap_odata":
        mark = lookup("TARGET_TABLE_NAME", target_table.upper())
        if mark is None:
            return None
        return (mark - (lookback or ODATA_LOOKBACK)).replace(hour=0, minute=0, second=0, microsecond=0)
    mark = lookup("SOURCE_OBJECT_NAME", source_object)
    return None if mark is None else _to_millis(mark - (lookback or LOOKBACK))


def _to_millis(at: datetime) -> datetime:
    return at.replace(microsecond=at.microsecond // 1000 * 1000)


def mark_text(c: Column) -> Column:
    return F.date_format(c, MILLIS)


def day_text(c: Column) -> Column:
    return F.date_format(c, DAY)


def new_mark(df: DataFrame, insert_col: str, update_col: str | None = None, old=None,
             insert_only: bool = False) -> DataFrame:
    """One row: greatest insert time, greatest update time, and the next watermark.

    Both maxima come from one pass. ``insert_only=True`` ignores update times, which can move a watermark
    backwards when only updates arrive; the default takes the greatest of both and of the old mark.
    """
    high_insert = F.max(moment(df, insert_col))
    high_update = F.max(moment(df, update_col)) if update_col else F.lit(None).cast("timestamp_ntz")
    maxima = df.agg(high_insert.alias("max_insert"), high_update.alias("max_update"))
    nxt = [F.col("max_insert")] if insert_only else [F.col("max_insert"), F.col("max_update")]
    if old is not None and not insert_only:
        nxt.append(as_mark(old))
    return maxima.withColumn("next_mark", nxt[0] if len(nxt) == 1 else F.greatest(*nxt))
