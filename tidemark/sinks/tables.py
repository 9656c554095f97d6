"""Target tables as versions, staging folders, chunked JSON, archive and retention."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.names import column, quote
from tidemark.functions.rows import comparable, differs
from tidemark.functions.times import ntz
from tidemark.operators.merge import INSERTED, UPDATED, data_columns
from tidemark.sinks.storage import child_dirs, exists, remove, touch


class VersionedTable:
    """A Parquet target whose every load writes a new folder ``v=<n>``.

    A version counts once Spark's commit marker ``_SUCCESS`` is in it, so a reader never sees half a load and a
    failed write is simply written again. A path is never overwritten while it is read.

    With another ``marker`` a version counts only after :meth:`commit`, i.e. once something that depends on it is
    done too.

    With ``buckets`` the version is a bucketed catalog table: a merge that shuffles then leaves the target
    where it is and moves the source only.
    """

    def __init__(self, spark: SparkSession, path: str, keys=(), buckets: int = 0, marker: str = "_SUCCESS"):
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), list(keys), buckets
        self.marker = marker

    def versions(self) -> list[int]:
        found = []
        for name in child_dirs(self.spark, self.path):
            m = re.fullmatch(r"v=(\d+)", name)
            if m and exists(self.spark, f"{self.path}/{name}/{self.marker}"):
                found.append(int(m.group(1)))
        return sorted(found)

    def current(self) -> int | None:
        found = self.versions()
        return found[-1] if found else None

    def version_path(self, version: int) -> str:
        return f"{self.path}/v={version:08d}"

    def read(self, version: int | None = None) -> DataFrame | None:
        version = version or self.current()
        if version is None:
            return None
        table = self._table_name(version)
        if self.buckets and self.spark.catalog.tableExists(table):
            return self.spark.table(table)
        return self.spark.read.parquet(self.version_path(version))

    def write(self, df: DataFrame) -> int:
        version = (self.current() or 0) + 1
        writer = df.write.mode("overwrite").option("compression", "snappy")
        if self.buckets:
            writer.bucketBy(self.buckets, *self.keys).sortBy(*self.keys).option("path", self.version_path(version)).saveAsTable(
                self._table_name(version))
        else:
            writer.parquet(self.version_path(version))
        return version

    def commit(self, version: int) -> None:
        touch(self.spark, f"{self.version_path(version)}/{self.marker}")

    def create(self, schema: T.StructType) -> int:
        """An empty first version, unless there is one."""
        return self.current() or self.write(self.spark.createDataFrame([], schema))

    def drop_old(self, keep: int = 2) -> list[int]:
        """Remove all but the newest ``keep`` versions."""
        old = self.versions()[:-keep]
        for v in old:
            if self.buckets:
                self.spark.sql(f"DROP TABLE IF EXISTS {self._table_name(v)}")
            remove(self.spark, self.version_path(v))
        return old

    def _table_name(self, version: int) -> str:
        base = re.sub(r"\W", "_", self.path.split("/")[-1])
        place = hashlib.sha256(self.path.encode()).hexdigest()[:12]  # tables of the same name in other folders
        return f"`{base}_{place}_v{version:08d}`"


def target_struct(schema: T.StructType) -> T.StructType:
    """A stage schema plus the two audit columns."""
    out = T.StructType(list(schema.fields))
    return out.add(INSERTED, T.TimestampNTZType(), True).add(UPDATED, T.TimestampNTZType(), True)


def write_stage(df: DataFrame, folder: str, run: str) -> str:
    """Stage one run as ``load_ts=<run>`` below the table's folder.

    A run never overwrites another, so the folder is at once the staging area and the archive: reading it whole
    gives every staged row with its ``load_ts``, and retention drops partitions. Nothing is copied.
    """
    path = f"{folder.rstrip('/')}/load_ts={run}"
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)
    return path


def read_stage(spark: SparkSession, folder: str, pattern: str = "*.parquet", schema=None) -> DataFrame:
    """All staged files below a folder whose name matches ``pattern``."""
    reader = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
    return (reader.schema(schema) if schema else reader).parquet(folder)


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.option("mergeSchema", True).parquet(folder)


def with_load_time(df: DataFrame, load_ts: str) -> DataFrame:
    """Stage rows as they enter an archive partitioned by load time."""
    return df.withColumn("load_ts", ntz(load_ts))


def append_archive(df: DataFrame, folder: str, load_ts: str) -> None:
    """For a stage that lives elsewhere: append its rows to a partitioned archive."""
    with_load_time(df, load_ts).write.mode("append").partitionBy("load_ts").parquet(folder)


def write_chunks(df: DataFrame, path: str, per_file: int) -> None:
    """JSON Lines with at most ``per_file`` documents per file. Missing fields are left out, so no bare NaN."""
    df.write.mode("overwrite").option("maxRecordsPerFile", per_file).json(path)


def expired(files: DataFrame, modified: str, now: Column, days: int = 30) -> DataFrame:
    """Entries of an inventory last modified more than ``days`` days before ``now``."""
    return files.where(column(modified) < now - F.make_dt_interval(F.lit(days)))


def drop_expired_stages(spark: SparkSession, folder: str, before: str) -> list[str]:
    """Remove staged runs whose ``load_ts`` sorts before ``before`` (a run label); returns their names."""
    old = [n for n in child_dirs(spark, folder) if n.startswith("load_ts=") and n.removeprefix("load_ts=") < before]
    for name in old:
        remove(spark, f"{folder.rstrip('/')}/{name}")
    return old


def merge_into(source: DataFrame, table: str, keys, stamp: str) -> None:
    """Upsert in place, for targets in a row-level table format (it rewrites only the files it must).

    Plain Parquet refuses this. ``source`` must hold one row per key.
    """
    target = source.sparkSession.table(table)
    names = data_columns(target)
    types = {f.name: f.dataType for f in target.schema.fields}

    def of(side, n):
        return f"{side}.{quote(n)}"

    on = F.expr(" AND ".join(f"{of(table, k)} = {of('source', k)}" for k in keys))
    changed = F.expr(differs([comparable(of("source", n), types[n]) for n in names],
                             [comparable(of(table, n), types[n]) for n in names]))
    values = {n: F.expr(of("source", n)) for n in names}
    (
        source.alias("source").mergeInto(table, on)
        .whenMatched(changed).update({**values, UPDATED: ntz(stamp)})
        .whenNotMatched().insert({**values, INSERTED: ntz(stamp)})
        .merge()
    )


def written_counts(table: VersionedTable, version: int, stamp: str, rows_before: int) -> dict:
    """Inserted, updated and deleted rows of a load, from the version it wrote.

    One scan of the two stamp columns; unlike counters gathered during the write it cannot count a retried
    task twice.
    """
    at = ntz(stamp)
    row = table.read(version).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(INSERTED) == at).alias("inserted"),
        F.count_if(F.col(UPDATED) == at).alias("updated"),
    ).first()
    return {
        "inserted": row["inserted"],
        "updated": row["updated"],
        "deleted": rows_before + row["inserted"] - row["rows"],
    }
