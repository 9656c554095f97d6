"""Relational sources through Spark JDBC.

User and password come from Spark conf (``spark.tidemark.<source>.user`` / ``.password``) or the environment
(``TIDEMARK_<SOURCE>_USER`` / ``_PASSWORD``), never from files in the repository.
"""

from __future__ import annotations

import os
from dataclasses import dataclass
from datetime import datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, types as T

from tidemark.functions.names import project

_DRIVERS = {
    "sqlserver": ("com.microsoft.sqlserver.jdbc.SQLServerDriver", "jdbc:sqlserver://{host}:{port};databaseName={database}"),
    "postgresql": ("org.postgresql.Driver", "jdbc:postgresql://{host}:{port}/{database}"),
}


@dataclass(frozen=True)
class Split:
    """A numeric, date or timestamp column and bounds for a parallel read."""

    column: str
    lower: str
    upper: str
    partitions: int


def options(spark: SparkSession, source: str, database: str, host: str | None = None, port: str | None = None) -> dict:
    """Connection options of one source system."""
    driver, url = _DRIVERS[source.lower()]
    place = {
        "host": host or setting(spark, source, "host"),
        "port": port or setting(spark, source, "port"),
        "database": database,
    }
    return {
        "driver": driver,
        "url": url.format(**place),
        "user": setting(spark, source, "user"),
        "password": setting(spark, source, "password"),
    }


def setting(spark: SparkSession, source: str, name: str) -> str:
    value = spark.conf.get(f"spark.tidemark.{source.lower()}.{name}", None)
    return value or os.environ.get(f"TIDEMARK_{source.upper()}_{name.upper()}", "")


def table_options(connection: dict, table: str, split: Split | None = None, fetch_size: int = 10_000) -> dict:
    """Options of a table scan; with a split it runs as ``partitions`` range queries instead of one.

    Zone-free times keep their wall clock, and comparing them with a watermark is pushed to the database.
    """
    out = {"preferTimestampNTZ": "true", **connection, "dbtable": table, "fetchsize": str(fetch_size)}
    if split:
        out |= {
            "partitionColumn": split.column,
            "lowerBound": split.lower,
            "upperBound": split.upper,
            "numPartitions": str(split.partitions),
        }
    return out


def read_table(spark: SparkSession, connection: dict, table: str, col_names: str | None = None,
               split: Split | None = None) -> DataFrame:
    """Scan with a column list. A later ``where`` or ``select`` becomes part of the remote query."""
    return project(spark.read.format("jdbc").options(**table_options(connection, table, split)).load(), col_names)


def read_query(spark: SparkSession, connection: dict, query: str, split: Split | None = None) -> DataFrame:
    """Run a query remotely. As a subquery it may be split too, which the ``query`` option refuses."""
    return spark.read.format("jdbc").options(**table_options(connection, f"({query}) subquery", split)).load()


def even_split(spark: SparkSession, connection: dict, table: str, name: str, partitions: int) -> Split | None:
    """Bounds of a numeric or time column, asked of the database in one row; None for an empty table."""
    row = read_query(spark, connection, bounds_query(table, name)).first()
    return None if row[0] is None else Split(name, str(row[0]), str(row[1]), partitions)


def bounds_query(table: str, name: str) -> str:
    return f"SELECT MIN({name}) AS low, MAX({name}) AS high FROM {table}"


#: Types whose order is the same in every database and whose values have a plain literal.
EVEN_TYPES = (T.IntegralType, T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType)


def quoted(name: str) -> str:
    """A column name as written in the database, whatever its case; both systems take double quotes."""
    return '"' + name.replace('"', '""') + '"'


def literal(value, source: str) -> str:
    """A bound as text of the database. Times are given their type, because a short form of it would refuse their fraction."""
    if isinstance(value, (int, float, Decimal)):
        return str(value)
    if isinstance(value, datetime):
        kind = "DATETIME2" if source.lower() == "sqlserver" else "TIMESTAMP"
        return f"CAST('{value.isoformat(sep=' ')}' AS {kind})"
    return "'" + str(value).replace("'", "''") + "'"


def changed_condition(mark: datetime, insert_col: str, update_col: str | None, source: str) -> str:
    """The increment as a condition on the table; it only sizes the slices, so columns of other types than times may differ."""
    names = dict.fromkeys(n for n in (insert_col, update_col) if n)
    return "(" + " OR ".join(f"{quoted(n)} > {literal(mark, source)}" for n in names) + ")"


def count_query(table: str, where: str | None = None) -> str:
    return f"SELECT COUNT(*) AS n FROM {table}" + (f" WHERE {where}" if where else "")


def slices_query(table: str, name: str, partitions: int, where: str | None = None) -> str:
    """Upper bounds of about equally many rows each, whatever the skew: one row per slice. ``name`` is written as given."""
    asked = f"{name} IS NOT NULL" + (f" AND {where}" if where else "")
    tiles = f"SELECT {name} AS k, NTILE({partitions}) OVER (ORDER BY {name}) AS slice FROM {table} WHERE {asked}"
    return f"SELECT slice, MAX(k) AS high FROM ({tiles}) tiles GROUP BY slice"


def slices(name: str, highs: list, source: str = "postgresql") -> list[str]:
    """Disjoint conditions that cover every row: up to each bound, beyond the last one, and rows without a value in a part of their own.

    Numbers and times may come in any order; texts come in the database's own, which is not Python's. A value that fills several
    slices keeps one.
    """
    highs = dict.fromkeys(highs)
    bounds = [literal(h, source) for h in (highs if any(isinstance(h, str) for h in highs) else sorted(highs))]
    out = [f"{name} > {low} AND {name} <= {high}" for low, high in zip(bounds, bounds[1:])]
    if bounds:
        out = [f"{name} <= {bounds[0]}", *out, f"{name} > {bounds[-1]}"]
    return [*out, f"{name} IS NULL"]


def split_column(rows: DataFrame, keys) -> str | None:
    """The first key that is a number or a time, as the database writes it; None where all are of other kinds."""
    found = {f.name.lower(): f for f in rows.schema.fields}
    fields = [found[k.lower()] for k in keys if k.lower() in found]
    return next((f.name for f in fields if isinstance(f.dataType, EVEN_TYPES)), None)


def read_slices(spark: SparkSession, connection: dict, table: str, name: str, partitions: int, col_names: str | None = None,
                where: str | None = None, least: int = 100_000, source: str = "postgresql") -> DataFrame:
    """Scan as one range query per slice, with bounds that the database finds among the rows that ``where`` leaves.

    There are no more slices than ``least`` rows each fill; below two of them nothing is sorted and the scan is one query.
    ``where`` only sizes the slices: the scan's own filter is the caller's.
    """
    n = read_query(spark, connection, count_query(table, where)).first()[0]
    partitions = min(partitions, n // least)
    if partitions < 2:
        return read_table(spark, connection, table, col_names)
    found = read_query(spark, connection, slices_query(table, quoted(name), partitions, where)).collect()  # one row per slice
    highs = [r["high"] for r in sorted(found, key=lambda r: r["slice"])]
    given = {k: v for k, v in table_options(connection, table).items() if k not in ("url", "dbtable")}
    parts = slices(quoted(name), highs, source)
    return project(spark.read.jdbc(connection["url"], table, predicates=parts, properties=given), col_names)


def catalog_query(table: str, schema: str, col_names: str | None = None) -> str:
    """Column catalog of one table from ``information_schema``."""
    def text(value):
        return "'" + value.replace("'", "''") + "'"

    query = (
        "SELECT column_name, data_type, ordinal_position FROM information_schema.columns "
        f"WHERE table_name = {text(table)} AND table_schema = {text(schema)}"
    )
    if col_names and col_names.strip() not in ("*", "-"):
        names = ", ".join(text(n.strip()) for n in col_names.split(","))
        query += f" AND column_name IN ({names})"
    return query
