"""Full and incremental loads over a job table.

    extract -> cast -> increment filter -> stage -> latest per key -> (delete) -> merge -> new version -> audit

Everything up to the stage is one lazy DataFrame, written once; the rest reads the stage, so a source is read
once per run and a merge knows the real size of its input.
"""

from __future__ import annotations

import getpass
import threading
import traceback
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.documents import canonical, field, numbers_to_text
from tidemark.functions.names import column, project
from tidemark.functions.times import parse, stamp_column
from tidemark.functions.typemap import cast_to
from tidemark.operators.audit import CONTROL_SCHEMA
from tidemark.operators.dedup import latest_per_key
from tidemark.operators.evolve import drift, evolve
from tidemark.operators.increment import Marks, changed_since, last_mark, new_mark
from tidemark.operators.merge import (
    changed_since_stamp, choose_strategy, delete_by_feed, has_changes, hot_keys, master_refresh, merge, next_version,
)
from tidemark.sinks.archive import SnapshotArchive
from tidemark.sinks.storage import child_dirs
from tidemark.sinks.tables import VersionedTable, drop_expired_stages, target_struct, write_stage, written_counts
from tidemark.spec import JobSpec, read_jobs

SYNTHETIC = "inserted_timestamp"
DOCUMENT = "JSON_DATA"
RUN_LABEL = "%Y%m%dT%H%M%S%f"


@dataclass
class Extract:
    """What a reader returns: rows, and optionally the types to cast them to."""

    rows: DataFrame
    schema: T.StructType | None = None


# (spark, job, mark) -> Extract or DataFrame. A reader may use the mark itself; the filter is applied anyway.
Reader = Callable[[SparkSession, JobSpec, object], "Extract | DataFrame"]


@dataclass(frozen=True)
class Outcome:
    job: JobSpec
    status: str
    inserted: int = 0
    updated: int = 0
    deleted: int = 0
    mark: datetime | None = None
    error: str = "-"


class Loader:
    """``readers`` by source name (``"file"`` for files); ``feeds`` give the deletion feed of a job.

    ``parallel`` jobs run at a time: small objects then share the cluster instead of queueing. ``buckets`` keeps
    targets bucketed by key, so that merges move the increment only. ``zone`` is the wall clock of all stamps.
    ``overrides`` gives (table, column) another Spark type. ``as_text`` lists, per document collection, paths whose numbers become text.
    ``addresses`` by source and ``target_name`` (database, schema) only label the rows of the control table.
    """

    def __init__(self, spark: SparkSession, root: str, readers: dict[str, Reader], feeds: dict[str, Reader] | None = None,
                 allow_drop: bool = False, strict_casts: bool = True, buckets: int = 0, parallel: int = 1,
                 zone: str = "UTC", keep_versions: int = 2, addresses: dict[str, str] | None = None,
                 target_name: tuple[str, str] | None = None, overrides: dict[tuple[str, str], str] | None = None,
                 as_text: dict[str, list[str]] | None = None,
                 clock: Callable[[], datetime] | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.readers, self.feeds = readers, feeds or {}
        self.allow_drop, self.strict_casts, self.buckets, self.parallel = allow_drop, strict_casts, buckets, parallel
        self.keep_versions = keep_versions
        self.as_text = {t.lower(): paths for t, paths in (as_text or {}).items()}
        self.overrides = {(t.lower(), c.lower()): kind for (t, c), kind in (overrides or {}).items()}
        self.addresses, self.target_name = addresses or {}, target_name or (None, None)
        self.clock = clock or (lambda: datetime.now(ZoneInfo(zone)).replace(tzinfo=None))
        self._log = threading.Lock()

    # -- entry points ----------------------------------------------------------------------------------

    def full_load(self, jobs) -> list[Outcome]:
        return self._run(jobs, incremental=False)

    def incr_load(self, jobs) -> list[Outcome]:
        return self._run(jobs, incremental=True)

    def _run(self, jobs, incremental):
        jobs = read_jobs(self.spark, jobs) if isinstance(jobs, str) else list(jobs)
        self._ensure_control()
        self._marks = Marks(self.control())  # the log is read once per load, not once per job
        # Jobs of one target run in the order given; only different targets run side by side.
        groups: dict[str, list[int]] = {}
        for i, job in enumerate(jobs):
            groups.setdefault(job.sf_tbl.lower(), []).append(i)
        with ThreadPoolExecutor(max_workers=max(1, self.parallel)) as pool:
            done = list(pool.map(lambda group: [(i, self._guarded(jobs[i], incremental)) for i in group], groups.values()))
        return [outcome for _, outcome in sorted((x for group in done for x in group), key=lambda x: x[0])]

    def _guarded(self, job, incremental) -> Outcome:
        """One failing object is logged and does not stop the others; its watermark stays where it was."""
        start = self.clock()
        try:
            outcome = self._load(job, incremental, start)
        except Exception as e:
            at = traceback.extract_tb(e.__traceback__)[-1]
            outcome = Outcome(job, "FAILED", error=f"{type(e).__name__} in {at.filename.split('/')[-1]}:{at.lineno}: {e}")
        self._audit(outcome, start, self.clock())
        return outcome

    # -- one object ------------------------------------------------------------------------------------

    def table(self, job: JobSpec) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root}/target/{job.sf_tbl.lower()}", job.keys, self.buckets)

    def control(self) -> DataFrame:
        """Runs so far. A run is appended to the current version's folder; :meth:`compact_control` starts a new one."""
        return self._control().read().select(*CONTROL_SCHEMA.names)

    def changed_keys(self, job: JobSpec, since: datetime) -> DataFrame:
        """Keys of rows inserted or updated at or after ``since`` (the RUN_START of a run), as a table."""
        return changed_since_stamp(self.table(job).read(), job.keys, since.isoformat(sep=" "))

    def compact_control(self) -> None:
        """Rewrite the many one-row files of past runs as one."""
        with self._log:
            table = self._control()
            table.write(table.read().coalesce(1))
            table.drop_old(keep=2)

    def drop_old_stages(self, days: int = 30) -> list[str]:
        """Remove staged runs older than ``days``; returns what was removed."""
        before = (self.clock() - timedelta(days=days)).strftime(RUN_LABEL)
        folders = [f"{self.root}/stage/{name}" for name in child_dirs(self.spark, f"{self.root}/stage")]
        return [f"{f}/{run}" for f in folders for run in drop_expired_stages(self.spark, f, before)]

    def _control(self) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root}/control")

    def _load(self, job, incremental, start) -> Outcome:
        stamp = start.isoformat(sep=" ", timespec="microseconds")
        table = self.table(job)
        target = table.read()
        mark = self._mark(job) if (incremental or job.asks_for_changes) and target is not None else None
        rows = self._extract(job, mark, stamp)
        evolved = False
        if target is not None:
            had = target.columns
            target, reload = evolve(target, rows.schema, self.allow_drop)
            evolved = target.columns != had
            if reload and mark is not None:
                mark = None
                rows = self._extract(job, None, stamp)
        insert_col, update_col = self._time_columns(job, rows)
        snapshot = None
        if job.source == "sap_odata":
            pass  # the service itself decides which rows belong to the asked day
        elif insert_col:
            rows = changed_since(rows, mark, insert_col, update_col)
        elif not job.is_master:
            archive = SnapshotArchive(self.spark, f"{self.root}/snapshot/{job.sf_tbl.lower()}", marker="_MERGED")
            snapshot = archive.write(rows)
            rows = self._new_in_snapshot(archive, snapshot, incremental)
        stage = write_stage(rows, f"{self.root}/stage/{job.sf_tbl.lower()}", start.strftime(RUN_LABEL))
        staged = self.spark.read.schema(rows.schema).parquet(stage)
        if target is None:
            target = self.spark.createDataFrame([], target_struct(rows.schema))
        staged = self._same_columns(target, staged)
        outcome = Outcome(job, "SUCCESS")
        feed = self._feed(job, mark)
        if staged.isEmpty() and (feed is None or job.is_master):
            table.create(target.schema)  # nothing to load; a master table keeps its rows, whatever its feed says
        else:
            next_at = new_mark(staged, insert_col, update_col, mark).first()["next_mark"] if insert_col else None
            version, before = self._write(job, table, target, staged, insert_col, update_col, feed, stamp, evolved)
            counts = written_counts(table, version, stamp, before)
            table.drop_old(self.keep_versions)
            if job.is_master:
                counts["deleted"] = 0
            outcome = Outcome(job, "SUCCESS", counts["inserted"], counts["updated"], counts["deleted"], next_at)
        if snapshot is not None:
            archive.commit(snapshot)
            archive.drop_old(keep=1)
        return outcome

    def _write(self, job, table, target, staged, insert_col, update_col, feed, stamp, evolved):
        keys = job.keys
        before = target.count()
        latest = latest_per_key(staged, keys, insert_col, update_col)
        if job.is_master or table.current() is None:
            return table.write(master_refresh(latest, stamp)), before
        strategy = choose_strategy(target, staged)
        hot = hot_keys(target, keys) if strategy == "shuffle" or feed is not None else []
        if feed is not None:
            target = delete_by_feed(target, feed, keys, hot)
        merged = merge(target, latest, keys, stamp, strategy, hot=hot)
        # an increment often holds only rows that the lookback read again: look before rewriting a target, whatever its size
        if feed is None and not evolved and not has_changes(merged):
            return table.current(), before
        return table.write(next_version(merged)), before

    def _feed(self, job, mark) -> DataFrame | None:
        if not job.deletes or job.source not in self.feeds:
            return None
        feed = self.feeds[job.source](self.spark, job, mark)
        return feed.rows if isinstance(feed, Extract) else feed

    def _extract(self, job, mark, stamp) -> DataFrame:
        reader = self.readers.get("file" if job.is_file else job.source)
        if reader is None:
            raise ValueError(f"no reader for source {job.source!r}")
        got = reader(self.spark, job, mark)
        got = got if isinstance(got, Extract) else Extract(got)
        if job.source == "mongodb":
            return document_rows(got.rows, job, self.as_text.get(job.obj_name.lower(), ()))
        rows = project(got.rows, job.col_names)
        rows = cast_to(rows, got.schema, self.strict_casts) if got.schema is not None else rows
        kinds = {c: self.overrides.get((job.obj_name.lower(), c.lower())) for c in rows.columns}
        if any(kinds.values()):
            rows = rows.withColumns({c: column(c).cast(kind) for c, kind in kinds.items() if kind})
        if job.insrt_time_col == SYNTHETIC:
            rows = stamp_column(rows, SYNTHETIC, stamp)
        return rows

    def _time_columns(self, job, rows):
        have = {c.lower(): c for c in rows.columns}
        insert_col = have.get((job.insrt_time_col or "").lower())
        update_col = have.get((job.updt_time_col or "").lower())
        return insert_col or update_col, update_col

    def _same_columns(self, target, staged):
        """Columns that the target keeps although the source dropped them are null in the stage."""
        _, missing = drift(staged.columns, target.columns)
        by_fold = {f.name.lower(): f for f in target.schema.fields}
        for name in missing:
            f = by_fold[name]
            staged = staged.withColumn(f.name, F.lit(None).cast(f.dataType))
        return staged

    def _new_in_snapshot(self, archive, snapshot, incremental) -> DataFrame:
        """For tables without a modification time: the rows of the current snapshot that the last one lacked.

        The current snapshot becomes the archive only when its rows are merged, so a failed run loses nothing.
        """
        current, last = archive.read(snapshot), archive.read()
        if not incremental or last is None or set(last.columns) != set(current.columns):
            return current
        return archive.diff(snapshot, archive.current())

    def _mark(self, job):
        return last_mark(self._marks, job.source, job.obj_type, job.obj_name, job.sf_tbl)

    # -- control table ---------------------------------------------------------------------------------

    def _ensure_control(self):
        self._control().create(CONTROL_SCHEMA)

    def _audit(self, o: Outcome, start, end):
        with self._log:
            row = self._audit_row(o, start, end, self._marks.last_run + 1)
            values = tuple(row.get(f.name) for f in CONTROL_SCHEMA.fields)
            self._append(self.spark.createDataFrame([values], CONTROL_SCHEMA).coalesce(1))
            self._marks.note(row)

    def _audit_row(self, o: Outcome, start, end, run_id: int) -> dict:
        job = o.job
        return {
            "RUN_ID": run_id, "RUN_START": start, "RUN_END": end,
            "DURATION_IN_SEC": (end - start).total_seconds(), "IP_ADDRESS": self.addresses.get(job.source),
            "TARGET_DATABASE_NAME": self.target_name[0], "TARGET_SCHEMA_NAME": self.target_name[1],
            "SOURCE_DATABASE_NAME": "-" if job.is_file else job.database_name,
            "SOURCE_SCHEMA_NAME": "-" if job.is_file else job.schema_name,
            "SOURCE_OBJECT_NAME": job.obj_name, "TARGET_TABLE_NAME": job.sf_tbl.upper(),
            "TRIGGERED_BY": self.spark.sparkContext.appName, "STATUS": o.status, "ERROR_MESSAGE": o.error,
            "ROWS_INSERTED": o.inserted, "ROWS_UPDATED": o.updated, "ROWS_DELETED": o.deleted,
            "MAX_TIMESTAMP": o.mark, "CREATED_TIMESTAMP": end, "CREATED_BY": getpass.getuser(),
        }

    def _append(self, runs: DataFrame) -> None:
        control = self._control()
        runs.write.mode("append").parquet(control.version_path(control.current()))


def document_rows(raw: DataFrame, job: JobSpec, as_text=()) -> DataFrame:
    """A VARIANT column -> key, times and canonical document text.

    The text is canonical (sorted keys), so documents compare as strings; ``parse_json`` turns it back. A time that cannot be read
    fails the job: as null it would keep its document out of every increment. Numbers at the paths ``as_text`` become text.
    """
    document = column(raw.columns[0])
    times = {n: parse(field(document, n), strict=True) for n in dict.fromkeys((job.insrt_time_col, job.updt_time_col)) if n}
    keys = {k: field(document, k) for k in job.keys}
    return raw.select(
        *[c.alias(n) for n, c in {**keys, **times}.items()], canonical(numbers_to_text(document, as_text)).alias(DOCUMENT))
