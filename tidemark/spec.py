"""Load jobs: one row of the job table per source object."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import SparkSession

from tidemark.functions.names import split_list

# The columns of the job table.
JOB_COLUMNS = (
    "CONTROL_ID", "SRC_DB_NAME", "DATABASE_NAME", "SCHEMA_NAME", "SERVICE_URL", "OBJ_TYPE", "OBJ_NAME",
    "INSRT_TIME_COL", "UPDT_TIME_COL", "PRIMARY_KEY_COL", "COL_NAMES", "IS_DELETION", "DELETED_TBL", "SF_TBL",
    "ENTITY_VALUE", "FILTER_VALUE", "CLIENT", "MASTER_TBL",
)


@dataclass(frozen=True)
class JobSpec:
    control_id: str | None = None
    src_db_name: str | None = None
    database_name: str | None = None
    schema_name: str | None = None
    service_url: str | None = None
    obj_type: str = "table"
    obj_name: str = ""
    insrt_time_col: str | None = None
    updt_time_col: str | None = None
    primary_key_col: str = ""
    col_names: str | None = None
    is_deletion: str | None = None
    deleted_tbl: str | None = None
    sf_tbl: str = ""
    entity_value: str | None = None
    filter_value: str | None = None
    client: str | None = None
    master_tbl: str | None = None

    @classmethod
    def from_row(cls, row: dict) -> "JobSpec":
        """``-`` and empty mean absent. A filter keeps its trailing blank: the date text is appended to it."""
        given = {}
        for f in fields(cls):
            value = row.get(f.name.upper())
            if value is None or value.strip() in ("", "-"):
                continue
            given[f.name] = value if f.name == "filter_value" else value.strip()
        return cls(**given)

    @property
    def keys(self) -> list[str]:
        return split_list(self.primary_key_col)

    @property
    def source(self) -> str:
        return (self.src_db_name or "").lower()

    @property
    def is_file(self) -> bool:
        return self.obj_type.lower() == "file"

    @property
    def deletes(self) -> bool:
        return (self.is_deletion or "").lower() == "yes"

    @property
    def is_master(self) -> bool:
        return (self.master_tbl or "").lower() == "yes"

    @property
    def asks_for_changes(self) -> bool:
        """An OData service or filter that only answers for a given day: its full load is incremental too."""
        return self.source == "sap_odata" and ("DELTA" in (self.service_url or "") or "DATE" in (self.filter_value or ""))


def read_jobs(spark: SparkSession, path: str) -> list[JobSpec]:
    """The job table. Columns go by header name, so older and shorter forms load too; blank lines drop out.

    It has one row per source object, so it is read to the driver.
    """
    rows = spark.read.option("header", True).csv(path).collect()
    jobs = [JobSpec.from_row(r.asDict()) for r in rows]
    return [j for j in jobs if j.obj_name]
