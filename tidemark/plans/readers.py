"""Ready-made readers for :class:`tidemark.plans.loader.Loader`, one per kind of source."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from tidemark.functions.typemap import TypeMap, target_schema
from tidemark.operators.increment import deletes_since
from tidemark.plans.loader import Extract, Reader
from tidemark.sources import catalog, documents, files, jdbc, odata


def relational(source: str, connection: dict | None = None, split_on: dict[str, str] | None = None, partitions: int = 64,
               type_map: TypeMap | None = None) -> Reader:
    """SQL Server or PostgreSQL tables. A scan is split along the column that ``split_on`` names for the object, else along the first
    key that is a number or a time, into slices of about equally many rows past the mark; few rows, no such key, or ``partitions=1``
    make it one query.

    The loader's column list and increment filter become part of the remote query. With a ``type_map`` the columns get the types
    that it gives to those of the database's own catalog.
    """
    def read(spark, job, mark):
        options = connection or jdbc.options(spark, source, job.database_name)
        table = f"{job.schema_name}.{job.obj_name}"
        rows = jdbc.read_table(spark, options, table, job.col_names)
        if partitions > 1:
            found = {c.lower(): c for c in rows.columns}
            asked = (split_on or {}).get(job.obj_name)
            name = found.get(asked.lower(), asked) if asked else jdbc.split_column(rows, job.keys)
            # only times the scan itself has in the table size the slices; a load-time column of the loader's own is not there
            times = [found.get((c or "").lower()) for c in (job.insrt_time_col, job.updt_time_col)]
            past = jdbc.changed_condition(mark, times[0] or times[1], times[1], source) if mark and any(times) else None
            if name:
                rows = jdbc.read_slices(spark, options, table, name, partitions, job.col_names, past, source=source)
        if type_map is None:
            return rows
        asked = jdbc.read_query(spark, options, jdbc.catalog_query(job.obj_name, job.schema_name, job.col_names))
        found = asked.orderBy("ordinal_position").collect()  # one row per column
        return Extract(rows, target_schema([(r[0], r[1]) for r in found], source, type_map, table=job.obj_name))

    return read


def relational_deletes(source: str, connection: dict | None = None) -> Reader:
    """Keys of the deletions logged after the mark."""
    def read(spark, job, mark):
        options = connection or jdbc.options(spark, source, job.database_name)
        feed = jdbc.read_table(spark, options, f"{job.schema_name}.{job.deleted_tbl}")
        return deletes_since(feed, mark, job.keys, job.insrt_time_col)

    return read


def sheets(folder: str, pattern: str = "*.xlsx", type_map: TypeMap | None = None, text_columns: dict | None = None,
           coerced: dict | None = None, multi_line: bool = False, first_of_many: bool = False) -> Reader:
    """Landed workbooks or CSV files, found by table name, typed by their values.

    ``text_columns`` and ``coerced`` give columns per table (lower case) that are text, or times to coerce. Several files of one
    table are an error unless ``first_of_many`` takes the first.
    """
    def read(spark, job, mark):
        found = files.file_of(files.inventory(spark, folder, pattern), job.obj_name).first()
        if found["matching"] == 0 or (found["matching"] > 1 and not first_of_many):
            raise ValueError(f"table {job.obj_name}: {found['matching']} files in {folder} carry its name, one is needed")
        name = job.obj_name.lower()
        sheet = files.read_sheet(spark, found["path"], (text_columns or {}).get(name, ()), (coerced or {}).get(name, ()), multi_line)
        found = catalog.file_catalog(sheet).orderBy("ordinal_position").collect()  # one row per column
        types = [(r.column_name, r.data_type) for r in found]
        return Extract(sheet, target_schema(types, "EXCEL", type_map or TypeMap(), table=job.obj_name))

    return read


def landed_documents(folder: str, arrays: bool = False, rejects: str | None = None) -> Reader:
    """Landed JSON Lines, or files holding one JSON array each. Broken lines fail the job, or go to a folder below ``rejects``."""
    def read(spark, job, mark):
        path = f"{folder.rstrip('/')}/{job.obj_name}"
        if arrays:
            return documents.read_arrays(spark, path)
        return documents.read_lines(spark, path, rejects and f"{rejects.rstrip('/')}/{job.obj_name}")

    return read


def collection(uri: str) -> Reader:
    """A MongoDB collection through its Spark connector; only documents past the mark leave the server."""
    def read(spark, job, mark):
        times = {"created": job.insrt_time_col, "updated": job.updt_time_col}
        rows = documents.read_collection(spark, uri, job.database_name, job.obj_name, mark, **{k: v for k, v in times.items() if v})
        return rows.select(F.to_variant_object(F.struct("*")).alias(documents.RAW))

    return read


def entities(type_map: TypeMap | None = None, service: type[odata.ODataSource] = odata.ODataSource,
             splits: dict[str, list[str]] | None = None, parallel: int = 8, **options) -> Reader:
    """An OData entity set: columns from the service's metadata, rows page by page on the executors, in key order.

    A set is read in ``parallel`` ranges of its first key that has a literal form. ``splits`` gives, per entity set, filters that cut
    it into disjoint parts instead.
    """
    def read(spark, job, mark):
        url, client = job.service_url.rstrip("/") + "/", job.client or ""
        text = service.fetch(f"{url}$metadata{client}", options).decode()
        found = catalog.of_entity_set(catalog.metadata_columns(spark, text), job.entity_value).collect()  # one row per column
        if not found:
            raise ValueError(f"the metadata of {url} describe no entity set {job.entity_value}")
        types = [(r.column_name, r.data_type) for r in found]
        asked = odata.filter_text(job.filter_value, job.service_url, mark.strftime("%Y%m%d") if mark else None)
        parts = (splits or {}).get(job.entity_value)
        kinds = {n.lower(): (n, t) for n, t in types}
        ranged = next((kinds[k.lower()] for k in job.keys if kinds.get(k.lower(), ("", ""))[1].lower() in odata.LITERALS), None)
        given = {"order": ",".join(job.keys), **options, "url": url, "entity": job.entity_value, "client": client}  # this job's alone
        given |= ({"filter": asked} if asked else {}) | ({"splits": json.dumps(parts)} if parts else {})
        if ranged:
            given |= {"parallel": str(parallel), "range_key": ranged[0], "range_type": ranged[1]}
        rows = odata.read_entities(spark, [n for n, _ in types], service, **given)
        return odata.typed_entities(rows, types, type_map or TypeMap())

    return read
