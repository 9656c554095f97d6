"""Column catalogs: (column_name, data_type, ordinal_position) of a source or target."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.names import clean_header, column, split_list
from tidemark.operators.merge import AUDIT_COLUMNS

CATALOG = "column_name string, data_type string, ordinal_position int"

# Text shapes by which a file column counts as whole number, number or timestamp.
WHOLE = r"^[+-]?[0-9]+$"
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
MOMENT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?)?$"


def typed_catalog(df: DataFrame, col_names: str | None = None) -> DataFrame:
    """Catalog of a typed DataFrame, from its schema alone, by position."""
    wanted = None if col_names is None or col_names.strip() in ("*", "-") else {n.lower() for n in split_list(col_names)}
    rows = [
        (f.name, f.dataType.simpleString(), i)
        for i, f in enumerate(df.schema.fields, start=1)
        if wanted is None or f.name.lower() in wanted
    ]
    return df.sparkSession.createDataFrame(rows, CATALOG)


def file_catalog(df: DataFrame) -> DataFrame:
    """Catalog of a landed sheet: types are inferred from all values of each column.

    One aggregation over the whole input, combined map-side to one row. Names follow the spreadsheet rules:
    ``int64`` and ``bool`` need a value in every row, ``float64`` covers numbers with gaps and empty columns,
    ``datetime64[ns]`` needs a time in every non-empty cell, anything else is ``object``.
    """
    checks = []
    for i, name in enumerate(df.columns):
        c = column(name).cast("string")
        checks += [
            F.count(c).alias(f"n{i}"),
            F.count_if(c.rlike(WHOLE)).alias(f"w{i}"),
            F.count_if(c.rlike(NUMBER)).alias(f"f{i}"),
            F.count_if(c.rlike(MOMENT)).alias(f"t{i}"),
            F.count_if(F.lower(c).isin("true", "false")).alias(f"b{i}"),
        ]
    facts = df.agg(F.count(F.lit(1)).alias("rows"), *checks)
    entries = [
        F.struct(F.lit(clean_header(name)).alias("column_name"), _kind(i).alias("data_type"),
                 F.lit(i + 1).alias("ordinal_position"))
        for i, name in enumerate(df.columns)
    ]
    return facts.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def _kind(i):
    rows, n = F.col("rows"), F.col(f"n{i}")
    return (
        F.when(n == 0, "float64")
        .when((F.col(f"b{i}") == n) & (n == rows), "bool")
        .when((F.col(f"w{i}") == n) & (n == rows), "int64")
        .when(F.col(f"f{i}") == n, "float64")
        .when(F.col(f"t{i}") == n, "datetime64[ns]")
        .otherwise("object")
    )


def target_columns(df: DataFrame) -> list[str]:
    """Columns of a target by position, without the audit columns."""
    return [c for c in df.columns if c not in AUDIT_COLUMNS]


def entity_columns(metadata: DataFrame, xml: str) -> DataFrame:
    """(entity_type, column_name, data_type) from a column of EDMX ``EntityType`` elements."""
    shape = "_Name string, Property array<struct<_Name string, _Type string>>"
    return metadata.select(F.from_xml(F.col(xml), shape).alias("e")).select(
        F.col("e._Name").alias("entity_type"), F.explode("e.Property").alias("p")
    ).select("entity_type", F.col("p._Name").alias("column_name"), F.col("p._Type").alias("data_type"))


def read_edmx(spark, path: str) -> DataFrame:
    """The same from landed EDMX files."""
    shape = "_Name string, Property array<struct<_Name string, _Type string>>"
    types = spark.read.format("xml").option("rowTag", "EntityType").schema(shape).load(path)
    return types.select(F.col("_Name").alias("entity_type"), F.explode("Property").alias("p")).select(
        "entity_type", F.col("p._Name").alias("column_name"), F.col("p._Type").alias("data_type"))


def metadata_columns(spark, document: str) -> DataFrame:
    """The same from the text of one service's metadata document; decimals carry their facets."""
    prop = "struct<_Name string, _Type string, _Precision string, _Scale string>"
    shape = f"DataServices struct<Schema array<struct<EntityType array<struct<_Name string, Property array<{prop}>>>>>>"
    text = spark.createDataFrame([(document,)], "text string")
    types = text.select(F.from_xml("text", shape, {"ignoreNamespace": "true"}).alias("e")).select(
        F.explode(F.flatten("e.DataServices.Schema.EntityType")).alias("t"))
    p = types.select(F.col("t._Name").alias("entity_type"), F.explode("t.Property").alias("p"))
    facets = F.concat(F.lit("("), F.col("p._Precision"), F.lit(","), F.coalesce("p._Scale", F.lit("0")), F.lit(")"))
    kind = F.when(F.col("p._Type") == "Edm.Decimal", F.concat(F.col("p._Type"), F.coalesce(facets, F.lit(""))))
    return p.select("entity_type", F.col("p._Name").alias("column_name"), F.coalesce(kind, "p._Type").alias("data_type"))


def of_entity_set(catalog: DataFrame, entity_set: str) -> DataFrame:
    """Columns of the entity type behind an entity set: its name without ``Set``, in any case."""
    return catalog.where(F.lower("entity_type") == entity_set[:-3].lower())


def with_synthetic(catalog: DataFrame, name: str = "inserted_timestamp", data_type: str = "Edm.DateTime") -> DataFrame:
    """Append the synthetic load-time column unless the catalog has it."""
    extra = catalog.sparkSession.createDataFrame([(name, data_type)], "column_name string, data_type string")
    missing = extra.join(F.broadcast(catalog.where(F.col("column_name") == name).select("column_name").limit(1)),
                         "column_name", "left_anti")
    return catalog.unionByName(missing, allowMissingColumns=True)
