"""OData entity sets: filter text, a paged reader, and landed pages."""

from __future__ import annotations

import base64
import json
import os
import urllib.error
import urllib.parse
import urllib.request

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tidemark.functions.names import column
from tidemark.functions.rows import plain
from tidemark.functions.typemap import TypeMap, cast_to, target_schema

PAGE = 500
#: EDM type: literal of a value in a filter; version 2 marks some types
LITERALS = {
    "edm.string": lambda v, v2: "'" + str(v).replace("'", "''") + "'",
    "edm.byte": lambda v, v2: str(int(v)),
    "edm.int16": lambda v, v2: str(int(v)),
    "edm.int32": lambda v, v2: str(int(v)),
    "edm.int64": lambda v, v2: f"{int(v)}L" if v2 else str(int(v)),
    "edm.decimal": lambda v, v2: f"{v}M" if v2 else str(v),
    "edm.guid": lambda v, v2: f"guid'{v}'" if v2 else str(v),
}


def filter_text(filter_value: str | None, service_url: str, mark: str | None) -> str | None:
    """Text of ``$filter``.

    A filter that mentions DATE ends where the mark goes; any other filter is used as it is; without a filter,
    delta services are asked for the mark's day and plain services for everything. Without a mark the DATE
    comparison is left out: a full extract.
    """
    if filter_value:
        if "DATE" not in filter_value:
            return filter_value
        if mark is None:
            return filter_value.rsplit("'DATE'", 1)[0].rstrip().removesuffix(" and").strip() or None
        return f"{filter_value}'{mark}'"
    if "DELTA" not in service_url or mark is None:
        return None
    return f"'DATE' eq '{mark}'"


def filter_column(filter_value: Column, service_url: Column, mark: Column) -> Column:
    """The same rule with a mark, as a column expression over many jobs."""
    quoted = F.concat(F.lit("'"), mark, F.lit("'"))
    has_filter = filter_value.isNotNull() & (filter_value != "")
    return (
        F.when(has_filter & filter_value.contains("DATE"), F.concat(filter_value, quoted))
        .when(has_filter, filter_value)
        .when(service_url.contains("DELTA"), F.concat(F.lit("'DATE' eq "), quoted))
    )


def flatten_entities(df: DataFrame) -> DataFrame:
    """Scalars stay, lists and objects become JSON text, times become text."""
    return plain(df)


def read_pages(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Landed JSON pages, each ``{"d": {"results": [...]}}`` (or ``{"value": [...]}``), one row per entity."""
    reader = spark.read.option("multiLine", True)
    pages = (reader.schema(schema) if schema else reader).json(path)
    items = F.col("d.results") if "d" in pages.columns else F.col("value")
    return flatten_entities(pages.select(F.explode(items).alias("_e")).select("_e.*"))


def wall_clock(c: Column) -> Column:
    """OData time text, ``/Date(<milliseconds>)/`` or ISO, as a zone-free timestamp."""
    millis = F.regexp_extract(c, r"^/Date\((-?\d+)([+-]\d{4})?\)/$", 1).try_cast("bigint")
    moment = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=millis / F.lit(1000).cast("decimal(10,3)"))
    return F.coalesce(moment, c.try_cast("timestamp_ntz"))


def time_of_day(c: Column) -> Column:
    """``PT12H30M05S`` as that time on the first day of 1970."""
    def part(unit):
        return F.regexp_extract(c, rf"(\d+){unit}", 1).try_cast("int")

    h, m, sec = [F.coalesce(part(u), F.lit(0)) for u in "HMS"]
    at = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), h, m, sec.cast("decimal(18,6)"))
    return F.when(c.rlike(r"^PT(\d+H)?(\d+M)?(\d+(\.\d+)?S)?$"), at)


def typed_entities(df: DataFrame, catalog, type_map: TypeMap, strict: bool = False) -> DataFrame:
    """Entities read as text -> the types of their column catalog (name, EDM type)."""
    readers = {"edm.datetime": wall_clock, "edm.datetimeoffset": wall_clock, "edm.time": time_of_day}
    moments = {n: readers[t.lower()](column(n)) for n, t in catalog if t.lower() in readers and n in df.columns}
    present = [(n, t) for n, t in catalog if n in df.columns]
    return cast_to(df.withColumns(moments) if moments else df, target_schema(present, "SAP_ODATA", type_map, strict), strict)


class ODataSource(DataSource):
    """``spark.read.format("odata").option("url", ...).option("entity", ...).schema(...)``.

    Options: ``url``, ``entity``, ``filter``, ``client`` (query text such as ``?key=value``), ``page`` (rows asked for per request),
    ``order`` (key columns; pages need a stable order), ``splits`` (a JSON list of filters that cut the entity set into disjoint
    parts, one reader each), ``parallel`` with ``range_key`` and ``range_type`` (a column and its EDM type: without ``splits``, the set is
    cut into so many ranges of that column), ``prefer`` (a Prefer header), ``user_env`` / ``password_env`` (names of environment variables).

    Ranges come from the service: its count, then one row at each quantile in its own order, so that they hold about equally many
    rows and follow the service's collation. Rows whose key is null are a part of their own. A set that fits in one page, a service
    that does not count, and a type without a known literal are read in one part.

    A reader follows the service's links to the next page. A service without links is asked to skip what has arrived so far, until
    a page is empty, so it may cap its pages as it likes.
    """

    @classmethod
    def name(cls):
        return "odata"

    def reader(self, schema):
        return ODataReader(schema, dict(self.options), self.fetch)

    @staticmethod
    def fetch(url: str, options: dict) -> bytes:
        request = urllib.request.Request(url, headers={"Accept": "application/json"})
        if options.get("prefer"):
            request.add_header("Prefer", options["prefer"])
        user = os.environ.get(options.get("user_env", "TIDEMARK_SAP_ODATA_USER"), "")
        if user:
            secret = os.environ.get(options.get("password_env", "TIDEMARK_SAP_ODATA_PASSWORD"), "")
            token = base64.b64encode(f"{user}:{secret}".encode()).decode()
            request.add_header("Authorization", f"Basic {token}")
        with urllib.request.urlopen(request, timeout=300) as reply:
            return reply.read()


class ODataReader(DataSourceReader):
    def __init__(self, schema, options, fetch):
        self.schema, self.options, self.fetch = schema, options, fetch
        self.page = int(options.get("page", PAGE))
        self.splits = json.loads(options.get("splits") or "[]")

    def partitions(self):
        return [InputPartition(x) for x in self.splits or self.ranges()]

    def ranges(self) -> list[str | None]:
        """Filters of disjoint key ranges that hold about equally many entities; one open part where that cannot be had."""
        key, kind, parts = self.options.get("range_key"), self.options.get("range_type", ""), int(self.options.get("parallel", 1))
        if parts < 2 or not key or kind.lower() not in LITERALS:
            return [None]
        try:
            total = int(self.fetch(self.address("/$count", []), self.options).decode("utf-8-sig"))
        except (urllib.error.HTTPError, ValueError):
            return [None]
        parts = min(parts, -(-total // self.page))
        bounds = []
        for i in range(1, parts):
            probe = [f"$skip={i * total // parts}", "$top=1", "$format=json", f"$select={urllib.parse.quote(key)}", f"$orderby={urllib.parse.quote(key)}"]
            body = self.fetch(self.address("", probe), self.options)
            found, _ = _page(body)
            value = found[0].get(key) if found else None
            bound = None if value is None else LITERALS[kind.lower()](value, b'"d"' in body[:50])
            if bound is not None and bound not in bounds:
                bounds.append(bound)
        if not bounds:
            return [None]
        inner = [f"{key} ge {a} and {key} lt {b}" for a, b in zip(bounds, bounds[1:])]
        return [f"{key} lt {bounds[0]}", *inner, f"{key} ge {bounds[-1]}", f"{key} eq null"]

    def address(self, path: str, query: list[str], split: str | None = None) -> str:
        o = self.options
        client = o.get("client", "").lstrip("?")
        asked = [x for x in (o.get("filter"), split) if x]
        if asked:
            query = [*query, "$filter=" + urllib.parse.quote(" and ".join(f"({x})" for x in asked) if len(asked) > 1 else asked[0])]
        query = ([client] if client else []) + query
        return f"{o['url'].rstrip('/')}/{o['entity']}{path}" + ("?" + "&".join(query) if query else "")

    def url(self, skip: int, split: str | None = None) -> str:
        order = self.options.get("order")
        query = [f"$skip={skip}", f"$top={self.page}", "$format=json"] + (["$orderby=" + urllib.parse.quote(order)] if order else [])
        return self.address("", query, split)

    def read(self, partition):
        names, split = self.schema.fieldNames(), partition.value
        url, arrived, linked = self.url(0, split), 0, False
        while url:
            entities, link = _page(self.fetch(url, self.options))
            for e in entities:
                yield tuple(_text(e.get(n)) for n in names)
            arrived += len(entities)
            if link:
                url, linked = urllib.parse.urljoin(url, link), True
            else:
                url = None if linked or not entities else self.url(arrived, split)


def _page(body: bytes) -> tuple[list[dict], str | None]:
    """Entities of a reply and the link to the next page, in the forms of versions 2 to 4."""
    reply = json.loads(body)
    inner = reply.get("d", reply)
    if isinstance(inner, list):
        return inner, None
    link = inner.get("__next") or reply.get("@odata.nextLink") or reply.get("odata.nextLink")
    return inner.get("results", inner.get("value", [])), link


def _text(value):
    if value is None or isinstance(value, str):
        return value
    return json.dumps(value, ensure_ascii=False)


def read_entities(spark: SparkSession, columns, source: type[DataSource] = ODataSource, **options) -> DataFrame:
    """Entities as string columns; types follow from the column catalog in a later cast."""
    spark.dataSource.register(source)
    schema = ", ".join(f"`{c}` string" for c in columns)
    return spark.read.format(source.name()).schema(schema).options(**options).load()
