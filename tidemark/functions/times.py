"""Timestamps as zone-free wall-clock values (TIMESTAMP_NTZ), whatever the session time zone is."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.names import column

# What the control table holds for "nothing read" or "failed", and the text formats used.
SENTINEL = "9999-12-31 23:59:59.999"
MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"
MILLIS = "yyyy-MM-dd HH:mm:ss.SSS"
DAY = "yyyyMMdd"
LOOKBACK = timedelta(minutes=10)
ODATA_LOOKBACK = timedelta(days=2)

_TWO_FORMATS = r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}(\.\d{1,6})?$"
_ISO = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?$"
_ISO_ZONE = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:\d{2})$"


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def to_text(c: Column) -> Column:
    """Timestamp -> text with six fraction digits."""
    return F.date_format(c, MICROS)


def timestamps_to_text(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            to_text(column(f.name)).alias(f.name)
            if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))
            else column(f.name)
            for f in df.schema.fields
        ]
    )


def coerce(c: Column) -> Column:
    """Any readable timestamp text; unreadable text becomes null."""
    return c.try_cast("timestamp_ntz")


def parse(c: Column, strict: bool = False) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` with or without a fraction, or the ISO form with ``T`` and perhaps a zone, which is turned into UTC;
    null and ``NaT`` become null.

    Other text is an error when ``strict``, null otherwise (count it with :func:`unparsed`).
    """
    # text of another form is extracted as '', which no cast can read
    plain = F.regexp_extract(c, _TWO_FORMATS, 0).try_cast("timestamp_ntz")
    iso = F.regexp_extract(c, _ISO, 0).try_cast("timestamp_ntz")
    zoned = F.regexp_extract(c, _ISO_ZONE, 0).try_cast("timestamp").cast("timestamp_ntz")
    value = F.coalesce(plain, iso, F.convert_timezone(F.current_timezone(), F.lit("UTC"), zoned))
    if not strict:
        return value
    message = F.concat(F.lit("unreadable time: "), c)
    return F.when(unparsed(c), F.raise_error(message).cast("timestamp_ntz")).otherwise(value)


def unparsed(c: Column) -> Column:
    """True for text that :func:`parse` cannot read."""
    return F.coalesce(c != "NaT", F.lit(False)) & parse(c).isNull()


def shift_zone(c: Column, zone: str, source: str = "UTC") -> Column:
    """Wall clock in ``source`` -> wall clock in ``zone``."""
    return F.convert_timezone(F.lit(source), F.lit(zone), c)


def now(zone: str = "UTC") -> Column:
    utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.localtimestamp())
    return shift_zone(utc, zone)


def back(c: Column, by: timedelta = LOOKBACK) -> Column:
    return c - F.lit(by)


def stamp_column(df: DataFrame, name: str, stamp: str) -> DataFrame:
    """A synthetic load-time column. The stamp is a literal of the run, so a re-run gives the same rows."""
    return df if name in df.columns else df.withColumn(name, ntz(stamp))
