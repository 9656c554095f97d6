"""Source type names -> warehouse type names -> Spark types."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.names import column

# First matching warehouse type per source type, per system with a connector.
TYPE_MAP = {
    "POSTGRESQL": {
        "serial": "number",
        "bigserial": "number",
        "int2": "number",
        "int4": "number",
        "int8": "number",
        "numeric": "decimal",
        "numeric_without_prec_scale": "varchar",
        "float4": "string",
        "float8": "float",
        "money": "varchar",
        "bytea": "binary",
        "varchar": "varchar",
        "bpchar": "varchar",
        "text": "varchar",
        "cidr": "varchar",
        "inet": "varchar",
        "macaddr": "varchar",
        "macaddr8": "varchar",
        "bit": "varchar",
        "uuid": "varchar",
        "xml": "varchar",
        "json": "object",
        "jsonb": "object",
        "tsvector": "varchar",
        "tsquery": "varchar",
        "timestamp": "timestamp_ntz",
        "timestamptz": "timestamp_ntz",
        "date": "date",
        "time": "time",
        "timetz": "time",
        "interval": "varchar",
        "point": "varchar",
        "line": "varchar",
        "lseg": "varchar",
        "box": "varchar",
        "path": "varchar",
        "polygon": "varchar",
        "circle": "varchar",
        "geometry": "geometry",
        "array": "varchar",
        "composite": "varchar",
        "range": "varchar",
        "oid": "number",
        "pg_lsn": "varchar",
        "bool": "boolean",
        "char": "varchar",
        "name": "varchar",
        "sl_timestamp": "timestamp_tz",
        "character varying": "varchar",
        "timestamp without time zone": "timestamp_ntz",
        "timestamp with timestamp": "timestamp_tz",
        "character": "varchar",
        "integer": "number",
        "bigint": "number",
        "boolean": "boolean",
    },
    "SQLSERVER": {
        "smallint": "number",
        "int": "number",
        "bigint": "number",
        "decimal": "decimal",
        "varchar": "varchar",
        "real": "string",
        "float": "float",
        "varbinary": "binary",
        "text": "object",
        "datetime2": "timestamp_ntz",
        "date": "date",
        "time": "time",
        "bit": "boolean",
        "char": "varchar",
        "datetimeoffset": "timestamp_tz",
        "datetime": "timestamp_ntz",
        "nvarchar": "varchar",
        "smalldatetime": "timestamp_ntz",
        "tinyint": "number",
        "binary": "varchar",
    },
    "EXCEL": {
        "float64": "string",
        "object": "varchar",
        "datetime64[ns]": "timestamp_ntz",
        "bool": "boolean",
        "int64": "varchar",
        "integer": "varchar",
    },
    "SAP_ODATA": {
        "Edm.Int16": "number",
        "Edm.Int32": "number",
        "Edm.Int64": "number",
        "Edm.String": "varchar",
        "Edm.Boolean": "boolean",
        "Edm.Guid": "varchar",
        "Edm.DateTime": "timestamp_ntz",
        "Edm.Decimal": "float",
        "Edm.Time": "timestamp_tz",
        "Edm.Double": "DOUBLE",
        "Edm.Binary": "Varchar",
        "Edm.Byte": "VARCHAR",
    },
}

# Spark type per warehouse type: (default, strict). Default keeps values whole; strict follows the map to the letter.
SPARK_TYPES = {
    "number": ("bigint", "decimal(38,0)"),
    "decimal": ("decimal(38,10)", "decimal(38,0)"),
    "varchar": ("string", "string"),
    "string": ("double", "string"),
    "float": ("double", "double"),
    "double": ("double", "double"),
    "binary": ("binary", "binary"),
    "object": ("variant", "variant"),
    "geometry": ("string", "string"),
    "timestamp_ntz": ("timestamp_ntz", "timestamp_ntz"),
    "timestamp_tz": ("timestamp", "timestamp"),
    "date": ("date", "date"),
    "time": ("string", "string"),
    "boolean": ("boolean", "boolean"),
}

# Where the default (value-keeping) Spark type of one source type departs from its warehouse type's.
_DEFAULT_BY_SOURCE = {
    ("EXCEL", "int64"): "bigint",
    ("SQLSERVER", "text"): "string",
}

# Correctly spelled and common names that the map lacks; used unless ``strict``.
_EXTRA = {
    "POSTGRESQL": {
        "timestamp with time zone": "timestamp_tz",
        "time without time zone": "time",
        "double precision": "float",
        "real": "float",
        "smallint": "number",
    },
    "SQLSERVER": {"numeric": "decimal", "nchar": "varchar", "uniqueidentifier": "varchar"},
    "SAP_ODATA": {"Edm.SByte": "number", "Edm.Single": "float", "Edm.DateTimeOffset": "timestamp_tz"},
}


@dataclass(frozen=True)
class Resolved:
    warehouse: str
    spark: str
    matched: bool


def default_rows() -> list[tuple[str, str, str]]:
    """(system, source type, warehouse type), in order."""
    return [(system, source, warehouse) for system, types in TYPE_MAP.items() for source, warehouse in types.items()]


def read_type_map(spark: SparkSession, path: str) -> list[tuple[str, str, str]]:
    """A type-map CSV: one column per system plus ``SNOWFLAKE``; the first row wins for each source type."""
    wide = spark.read.option("header", True).csv(path)
    rows, seen = [], set()
    for record in wide.toLocalIterator():
        for system in wide.columns:
            key = (system, (record[system] or "").lower())
            if system != "SNOWFLAKE" and key[1] and record["SNOWFLAKE"] and key not in seen:
                seen.add(key)
                rows.append((system, record[system], record["SNOWFLAKE"]))
    return rows


def system_of(source: str, obj_type: str = "table") -> str:
    """Files use the EXCEL column, everything else the upper-cased source name."""
    return "EXCEL" if obj_type.lower() == "file" else source.upper()


class TypeMap:
    """Case-insensitive lookup. Unknown types become varchar and are reported as unmatched, never skipped."""

    def __init__(self, rows=None, overrides=None):
        self.rows = list(rows or default_rows())
        self._by_key = {}
        for system, source, warehouse in self.rows:
            self._by_key.setdefault((system.upper(), source.lower()), warehouse)
        # (table, column) -> source type
        self.overrides = {(t.lower(), c.lower()): v for (t, c), v in (overrides or {}).items()}

    def resolve(self, system: str, source_type: str, strict: bool = False, table: str = "", name: str = "") -> Resolved:
        system = system.upper()
        asked = self.overrides.get((table.lower(), name.lower()), source_type).strip()
        base, facets = _split_facets(asked)
        warehouse = self._by_key.get((system, asked.lower())) or self._by_key.get((system, base.lower()))
        if warehouse is None and not strict:
            extra = {k.lower(): v for k, v in _EXTRA.get(system, {}).items()}
            warehouse = extra.get(base.lower())
        if warehouse is None:
            return Resolved("varchar", "string", False)
        spark = SPARK_TYPES[warehouse.lower()][1 if strict else 0]
        if not strict:
            spark = _DEFAULT_BY_SOURCE.get((system, base.lower()), spark)
            if facets and (warehouse.lower() == "decimal" or base.lower() == "edm.decimal"):
                spark = f"decimal({facets})"
        return Resolved(warehouse, spark, True)

    def frame(self, spark: SparkSession) -> DataFrame:
        """The map as a small table (about a hundred rows, fixed) for a broadcast lookup."""
        rows = [
            (i, s, t.lower(), w, self.resolve(s, t).spark)
            for i, (s, t, w) in enumerate(self.rows, start=1)
            if self._by_key[(s.upper(), t.lower())] == w
        ]
        return spark.createDataFrame(rows, "line int, system string, source_type string, warehouse_type string, spark_type string")


def _split_facets(name: str) -> tuple[str, str | None]:
    m = re.fullmatch(r"(.*?)\s*\(\s*(\d+\s*(?:,\s*\d+)?)\s*\)\s*", name)
    if not m:
        return name, None
    facets = re.sub(r"\s", "", m.group(2))
    return m.group(1), facets if "," in facets else facets + ",0"


def lookup(requests: DataFrame, type_map: TypeMap, system: Column, source_type: Column) -> DataFrame:
    """Add ``warehouse_type``, ``spark_type`` and ``matched`` to rows of type requests.

    The map is a fixed table of about a hundred rows, so the broadcast does not grow with the data.
    """
    spark = requests.sparkSession
    small = type_map.frame(spark).dropDuplicates(["system", "source_type"]).select(
        F.col("system").alias("_system"), F.col("source_type").alias("_type"), "warehouse_type", "spark_type"
    )
    joined = requests.join(
        F.broadcast(small), (F.upper(system) == F.col("_system")) & (F.lower(source_type) == F.col("_type")), "left"
    )
    return joined.select(
        *requests.columns,
        F.coalesce("warehouse_type", F.lit("varchar")).alias("warehouse_type"),
        F.coalesce("spark_type", F.lit("string")).alias("spark_type"),
        F.col("warehouse_type").isNotNull().alias("matched"),
    )


def target_schema(catalog_rows, system: str, type_map: TypeMap, strict: bool = False, table: str = "") -> T.StructType:
    """(name, source type) pairs -> Spark schema of the stage table."""
    schema = T.StructType()
    for name, source_type in catalog_rows:
        schema.add(name, T.DataType.fromDDL(type_map.resolve(system, source_type, strict, table, name).spark), True)
    return schema


def cast_to(df: DataFrame, schema: T.StructType, strict: bool = True) -> DataFrame:
    """Project ``df`` onto ``schema``: strict casts fail on bad values, lenient ones give null."""
    have = {f.name.lower(): f for f in df.schema.fields}
    out = []
    for f in schema.fields:
        source = have.get(f.name.lower())
        if source is None:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        c = column(source.name)
        if source.dataType != f.dataType:
            c = _cast(c, source.dataType, f.dataType, strict)
        out.append(c.alias(f.name))
    return df.select(*out)


def _cast(c: Column, have: T.DataType, want: T.DataType, strict: bool) -> Column:
    if isinstance(want, T.VariantType):
        if isinstance(have, T.StringType):
            return F.parse_json(c) if strict else F.try_parse_json(c)
        return F.to_variant_object(c) if isinstance(have, (T.StructType, T.ArrayType, T.MapType)) else c.cast(want)
    return c.cast(want) if strict else c.try_cast(want)


def failed_casts(df: DataFrame, schema: T.StructType) -> Column:
    """How many columns of a row hold a value that the lenient cast turns into null."""
    have = {f.name.lower(): f for f in df.schema.fields}
    bad = F.lit(0)
    for f in schema.fields:
        source = have.get(f.name.lower())
        if source is not None and source.dataType != f.dataType:
            c = column(source.name)
            bad = bad + (c.isNotNull() & _cast(c, source.dataType, f.dataType, False).isNull()).cast("int")
    return bad
