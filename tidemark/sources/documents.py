"""Document collections as one VARIANT column."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.sinks.storage import scratch_path

RAW = "raw_data"


def parse_documents(df: DataFrame, text: str, out: str = RAW) -> DataFrame:
    """Text -> VARIANT, parsed once; text that is not JSON becomes null (see :func:`rejects`)."""
    return df.withColumn(out, F.try_parse_json(F.col(text)))


def picked(text: Column, fields: str) -> Column:
    """Some fields of a JSON text as a struct, given as DDL; the rest of the document is skipped while parsing."""
    return F.from_json(text, fields)


def broken(text: Column) -> Column:
    """True for text that is neither blank nor JSON."""
    return F.coalesce(F.trim(text) != "", F.lit(False)) & F.try_parse_json(text).isNull()


def rejects(df: DataFrame, text: str) -> DataFrame:
    """The rows whose text cannot be parsed."""
    return df.where(broken(F.col(text)))


def read_lines(spark: SparkSession, path: str, reject_folder: str | None = None) -> DataFrame:
    """Landed JSON Lines, one document per row; blank lines hold none.

    A broken line fails the read, unless there is a folder for such lines: they are written there as text, in a folder of its own
    for each run, to be counted and mended, and the others are returned.
    """
    lines = spark.read.text(path).where(F.trim("value") != "")
    if reject_folder is not None:
        run = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f")
        rejects(lines, "value").write.text(f"{reject_folder.rstrip('/')}/run={run}")
        return parse_documents(lines, "value").where(F.col(RAW).isNotNull()).select(RAW)
    message = F.concat(F.lit("line without a JSON document: "), F.substring("value", 1, 200))
    return lines.select(F.when(broken(F.col("value")), F.raise_error(message).cast("variant")).otherwise(
        F.try_parse_json("value")).alias(RAW))


LARGE = 32 << 20


def read_arrays(spark: SparkSession, path: str, large: int = LARGE) -> DataFrame:
    """Landed files that each hold one JSON array: the outer array is stripped, each element becomes a row.

    Files beyond ``large`` bytes are cut into pieces that are parsed apart, see :func:`read_large_arrays`. A smaller one that cannot
    be read as one value fails by its name; it may also be a single document.
    """
    sizes = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")
    names = [[r.path for r in sizes.where(F.col("length") > large).collect()], [r.path for r in sizes.where(F.col("length") <= large).collect()]]
    if not names[0]:
        return _whole_arrays(spark, path)
    big = read_large_arrays(spark, names[0])
    return big.unionAll(_whole_arrays(spark, names[1])) if names[1] else big


def _whole_arrays(spark: SparkSession, path) -> DataFrame:
    files = spark.read.format("json").option("multiLine", True).option("singleVariantColumn", "whole").load(path)
    named = F.concat(F.lit("no JSON value could be read from "), F.input_file_name())
    whole = F.when(F.col("whole").isNull(), F.raise_error(named).cast("variant")).otherwise(F.col("whole"))
    return elements(files.select(whole.alias("whole")), "whole")


def _count(text: Column, letters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, letters, ""))


def read_large_arrays(spark: SparkSession, path) -> DataFrame:
    """The elements of JSON arrays in files of any size, each file read in blocks by many tasks.

    Files are read as pieces that end at a closing brace. What a piece does to the reader's state, in a string or not and how deep,
    depends on the state it begins in, so a block is worked on for both. Blocks are then composed in order: one row per block
    fixes the state each begins in, and with it where elements end. Only consecutive non-objects must fit in one value with
    the object after them. A file that does not close what it opens, or holds text that is no JSON, fails by its name.
    """
    file, block = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    pieces = spark.read.option("lineSep", "}").text(path).select(
        file.alias("file"), block.alias("block"), F.monotonically_increasing_id().alias("at"), F.col("value").alias("piece"))
    # an escape never reaches over a closing brace, as none can be escaped
    parts = F.split(F.regexp_replace("piece", r"(?s)\\.", ""), '"')
    even, odd = F.array_join(F.filter(parts, lambda x, i: i % 2 == 0), ""), F.array_join(F.filter(parts, lambda x, i: i % 2 == 1), "")
    flips = (F.size(parts) - 1) % 2
    shifts = [_count(text, "{[") - _count(text, "]") - F.when(flips == k, 1).otherwise(0) for k, text in ((0, even), (1, odd))]
    pieces = pieces.withColumns({"flips": flips, "outside": shifts[0], "inside": shifts[1]})
    here = Window.partitionBy("file", "block").orderBy("at")
    begun = F.coalesce(F.bit_xor("flips").over(here.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    pieces = pieces.withColumn("begun", begun).withColumns({
        "ended": F.col("begun").bitwiseXOR(F.col("flips")), "shift0": F.when(F.col("begun") == 0, F.col("outside")).otherwise(F.col("inside")),
        "shift1": F.when(F.col("begun") == 0, F.col("inside")).otherwise(F.col("outside"))})
    up_to = here.rowsBetween(Window.unboundedPreceding, 0)
    pieces = pieces.withColumns({"depth0": F.sum("shift0").over(up_to), "depth1": F.sum("shift1").over(up_to)})
    written = scratch_path(spark, "array-pieces")
    pieces.select("file", "block", "at", "piece", "ended", "depth0", "depth1").write.parquet(written)
    pieces = spark.read.parquet(written)

    blocks = pieces.groupBy("file", "block").agg(*[F.max_by(c, "at").alias(c) for c in ("ended", "depth0", "depth1")])
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("state", F.coalesce(F.bit_xor("ended").over(before), F.lit(0)))
    moved = F.when(F.col("state") == 0, F.col("depth0")).otherwise(F.col("depth1"))
    blocks = blocks.withColumns({"deep": F.coalesce(F.sum(moved).over(before), F.lit(0)), "left": F.sum(moved).over(Window.partitionBy("file")),
                                 "open": F.bit_xor("ended").over(Window.partitionBy("file"))})
    blocks = blocks.select("file", "block", "state", "deep", "left", "open")
    depth = F.col("deep") + F.when(F.col("state") == 0, F.col("depth0")).otherwise(F.col("depth1"))
    closes = (F.col("ended").bitwiseXOR(F.col("state")) == 0) & (depth == 1)
    placed = pieces.join(F.broadcast(blocks), ["file", "block"]).withColumn("closes", closes.cast("long"))  # a row per block of a file
    closed = placed.groupBy("file", "block").agg(F.sum("closes").alias("n")).select(
        "file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("lower"), F.sum("n").over(Window.partitionBy("file")).alias("all"))
    number = F.col("lower") + F.coalesce(F.sum("closes").over(here.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = placed.join(F.broadcast(closed), ["file", "block"]).withColumn("number", number)
    joined = numbered.groupBy("file", "number").agg(
        F.array_sort(F.collect_list(F.struct("block", "at", "piece"))).alias("p"), F.first("all").alias("all"),
        F.first("left").alias("left"), F.first("open").alias("open"))
    text = F.array_join(F.transform("p", lambda x: x["piece"]), "}")
    begin = F.when(F.col("number") == 0, r"^\s*\[").otherwise(r"^\s*,")
    rest = F.col("number") == F.col("all")  # after the last object; the last piece has no brace to end it
    body = F.when(rest, F.regexp_replace(text, r"\s*\]\s*$", "")).otherwise(F.concat(text, F.lit("}")))
    bare = F.regexp_replace(body, begin, F.lit(""))
    follows = body.rlike(r"^\s*,\s*\S") | (rest & body.rlike(r"^\s*$"))
    opened = F.when(F.col("number") == 0, text.rlike(r"^\s*\[")).otherwise(follows)
    named = F.concat(F.lit("no JSON array could be read from "), F.col("file"))
    good = opened & (F.col("left") == -1) & (F.col("open") == 0)
    value = F.try_parse_json(F.concat(F.lit("["), bare, F.lit("]")))
    checked = F.when(~good | value.isNull(), F.raise_error(named).cast("variant")).otherwise(value)
    return elements(joined.select(checked.alias("whole")), "whole")


def elements(df: DataFrame, array: str) -> DataFrame:
    """Rows of a VARIANT array; a single document counts as an array of one."""
    kind = F.schema_of_variant(F.col(array))
    many = F.when(kind.startswith("ARRAY"), F.variant_get(F.col(array), "$", "array<variant>")).otherwise(F.array(F.col(array)))
    return df.select(F.explode(many).alias(RAW))


def changed_pipeline(mark: datetime | None, created: str = "createdAt", updated: str = "updatedAt") -> str | None:
    """Aggregation pipeline that makes the collection return only documents past ``mark``."""
    if mark is None:
        return None
    at = {"$gt": {"$date": mark.isoformat(timespec="milliseconds") + "Z"}}
    return json.dumps([{"$match": {"$or": [{created: at}, {updated: at}]}}])


def collection_options(uri: str, database: str, collection: str, mark: datetime | None = None,
                       created: str = "createdAt", updated: str = "updatedAt") -> dict:
    out = {"connection.uri": uri, "database": database, "collection": collection}
    pipeline = changed_pipeline(mark, created, updated)
    return out | ({"aggregation.pipeline": pipeline} if pipeline else {})


def read_collection(spark: SparkSession, uri: str, database: str, collection: str, mark: datetime | None = None, **times) -> DataFrame:
    """Through the mongo-spark connector, which must be on the class path; it splits the collection itself."""
    return spark.read.format("mongodb").options(**collection_options(uri, database, collection, mark, **times)).load()


def union_documents(*frames: DataFrame) -> DataFrame:
    """Union by name; a key that one side lacks is null there."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
