"""Continuous upsert and bounded deduplication."""

from __future__ import annotations

from collections import deque
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from tidemark.functions.names import columns
from tidemark.functions.rows import any_null
from tidemark.operators.dedup import best_key, latest_per_key
from tidemark.operators.merge import choose_strategy, has_changes, hot_keys, merge, next_version
from tidemark.sinks.tables import VersionedTable, target_struct


def read_landing(spark: SparkSession, folder: str, schema, pattern: str | None = None, files_per_batch: int | None = 1000) -> DataFrame:
    """New Parquet files of a folder as a stream; without ``files_per_batch`` all that are new make one batch."""
    reader = spark.readStream.schema(schema)
    reader = reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader
    return (reader.option("pathGlobFilter", pattern) if pattern else reader).parquet(folder)


def upsert_stream(stream: DataFrame, table: VersionedTable, keys, insert_col: str, update_col: str | None,
                  checkpoint: str, stamp: str | None = None, keep_versions: int = 2, tiebreak=None) -> StreamingQuery:
    """Merge every micro-batch into ``table`` until the landing folder is drained.

    The checkpoint takes the place of the control-table watermark. A batch that is run again after a failure
    finds its rows already there and changes nothing. The target is the only state. Each batch writes a version,
    so batches should be large (``files_per_batch``); for small ones use a row-level table format.
    """
    def apply(batch: DataFrame, _batch_id: int) -> None:
        at = stamp or datetime.now(timezone.utc).replace(tzinfo=None).isoformat(sep=" ")
        if table.current() is None:
            table.create(target_struct(batch.schema))
        batch.persist()
        try:
            latest = latest_per_key(batch, keys, insert_col, update_col, tiebreak)
            target = table.read()
            strategy = choose_strategy(target, batch)
            hot = hot_keys(target, keys) if strategy == "shuffle" else []
            merged = merge(target, latest, keys, at, strategy, hot=hot, newer_by=(insert_col, update_col))
            if has_changes(merged):
                table.write(next_version(merged))
            table.drop_old(keep_versions)
        finally:
            batch.unpersist()

    return (
        stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def latest_stream(stream: DataFrame, table: VersionedTable, keys, insert_col: str, update_col: str | None, checkpoint: str,
                  stamp: str | None = None, keep_versions: int = 2, tiebreak=None) -> StreamingQuery:
    """Keep in ``table`` the latest row per key of all that the stream ever brought, in whatever order, until it is drained.

    The best row per key is the state of a streaming aggregation: each task leaves one row per key before the shuffle, so a key that
    floods the stream costs one row per task. A batch returns the keys that it touched, at most one row each, and these are
    merged; rows that arrive too late to win change nothing. State grows with the keys, not with the rows. Ties are settled
    as in :func:`latest_per_key`, null times winning.
    """
    def apply(batch: DataFrame, _batch_id: int) -> None:
        at = stamp or datetime.now(timezone.utc).replace(tzinfo=None).isoformat(sep=" ")
        if table.current() is None:
            table.create(target_struct(batch.schema))
        batch.persist()
        try:
            target = table.read()
            strategy = choose_strategy(target, batch)
            merged = merge(target, batch, keys, at, strategy, null_keys="reject")
            if has_changes(merged):
                table.write(next_version(merged))
            table.drop_old(keep_versions)
        finally:
            batch.unpersist()

    names = stream.columns
    best = F.max_by(F.struct(*columns(names)), best_key(stream, keys, insert_col, update_col, tiebreak)).alias("best")
    rows = stream.where("NOT " + any_null(keys)).groupBy(*columns(keys)).agg(best).select("best.*")
    return (rows.writeStream.outputMode("update").foreachBatch(apply).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def drop_repeats(stream: DataFrame, keys, time_col: str, lateness: str = "10 minutes") -> DataFrame:
    """First arrival per key within ``lateness``; state older than that is dropped.

    All rows of a key pass through one task. A source in which one key floods the stream belongs into
    :func:`upsert_stream`, which keeps one row per key and task before its shuffle.
    """
    return stream.withWatermark(time_col, lateness).dropDuplicatesWithinWatermark(list(keys))


def observed(df: DataFrame, name: str = "counts", **metrics: Column) -> DataFrame:
    """``df`` that counts its rows, and ``metrics`` besides, while it is written; see :class:`StreamAudit`."""
    return df.observe(name, F.count(F.lit(1)).alias("rows"), *[c.alias(k) for k, c in metrics.items()])


AUDIT = "query string, batch_id long, started timestamp_ntz, seconds double, rows_read long, rows_late long, observed map<string,string>"


class StreamAudit(StreamingQueryListener):
    """Logs each batch as it ends: rows read, rows too late for the watermark, seconds, and what :func:`observed` frames counted.

    Counts come with the pass that writes the rows; nothing is read again. With ``folder`` a row per batch is appended there as
    Parquet (columns of ``AUDIT``; ``observed`` has ``<name>.<metric>``), so that the log outlives the driver. ``batches`` holds
    (batch id, input rows, seconds) of the last ``keep`` batches, ``errors`` the reasons of failed stops.
    """

    def __init__(self, spark: SparkSession | None = None, folder: str | None = None, keep: int = 1000):
        self.spark, self.folder = spark, folder
        self.batches, self.errors = deque(maxlen=keep), []

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        self.batches.append((p.batchId, p.numInputRows, p.batchDuration / 1000.0))
        if self.folder:
            late = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
            counts = {f"{name}.{k}": None if v is None else str(v) for name, row in p.observedMetrics.items() for k, v in row.asDict().items()}
            started = datetime.fromisoformat(p.timestamp.replace("Z", "+00:00")).astimezone(timezone.utc).replace(tzinfo=None)
            row = (p.name or str(p.id), p.batchId, started, p.batchDuration / 1000.0, p.numInputRows, late, counts)
            self.spark.createDataFrame([row], AUDIT).coalesce(1).write.mode("append").parquet(self.folder)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        if event.exception:
            self.errors.append(event.exception)
