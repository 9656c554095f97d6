"""Schema drift: what changed between source and target columns, and carrying it into the target."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.functions.names import column
from tidemark.operators.merge import AUDIT_COLUMNS


def drift(source_columns, target_columns) -> tuple[list[str], list[str]]:
    """(added, missing): names only in the source, names only in the target; case and audit columns ignored."""
    audit = {a.lower() for a in AUDIT_COLUMNS}
    source = {c.strip().lower() for c in source_columns}
    target = {c.strip().lower() for c in target_columns} - audit
    return sorted(source - target), sorted(target - source)


def schema_drift(source_catalog: DataFrame, target_catalog: DataFrame) -> DataFrame:
    """The same over two column catalogs, as rows (column_name, status). A catalog has one row per column."""
    left = source_catalog.select(F.lower("column_name").alias("column_name"), F.lit(True).alias("_s")).distinct()
    right = target_catalog.select(F.lower("column_name").alias("column_name"), F.lit(True).alias("_t")).distinct()
    right = right.where(~F.col("column_name").isin([a.lower() for a in AUDIT_COLUMNS]))
    return left.join(right, "column_name", "full_outer").select(
        "column_name",
        F.when(F.col("_t").isNull(), "added").when(F.col("_s").isNull(), "missing").otherwise("same").alias("status"),
    )


def evolve_add(target: DataFrame, new_fields) -> DataFrame:
    """Add columns (null for existing rows) in front of the audit columns."""
    have = {c.lower() for c in target.columns}
    fields = [f for f in new_fields if f.name.lower() not in have]
    data = [column(c) for c in target.columns if c not in AUDIT_COLUMNS]
    audit = [column(c) for c in target.columns if c in AUDIT_COLUMNS]
    return target.select(*data, *[F.lit(None).cast(f.dataType).alias(f.name) for f in fields], *audit)


def evolve_drop(target: DataFrame, names, allow_drop: bool = False) -> DataFrame:
    """Remove columns that the source no longer has. This loses data, so it must be asked for."""
    if names and not allow_drop:
        raise ValueError(f"columns {list(names)} are gone from the source; pass allow_drop=True to drop them")
    gone = {n.lower() for n in names}
    return target.select(*[column(c) for c in target.columns if c.lower() not in gone])


def evolve(target: DataFrame, source_schema: T.StructType, allow_drop: bool = False) -> tuple[DataFrame, bool]:
    """Bring ``target`` to the source's columns.

    New columns are added and the caller must then load the full source, so that old rows get their values
    (second result True). Only when nothing was added are columns missing in the source dropped, or kept
    when dropping is not allowed.
    """
    added, missing = drift(source_schema.names, target.columns)
    if added:
        return evolve_add(target, [f for f in source_schema.fields if f.name.lower() in added]), True
    if missing and allow_drop:
        return evolve_drop(target, missing, True), False
    return target, False
