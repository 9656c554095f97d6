"""String cleaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.names import column

# The characters that str.strip removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column) -> Column:
    """Strip blanks, tabs and line breaks on both ends. Spark's plain ``trim`` removes blanks only."""
    return F.trim(c, F.lit(WHITESPACE))


def strip_strings(df: DataFrame, to_text=()) -> DataFrame:
    """Strip every string column; columns named in ``to_text`` become strings first. Null stays null."""
    out = []
    for f in df.schema.fields:
        c = column(f.name)
        if isinstance(f.dataType, T.StringType):
            c = strip(c).alias(f.name)
        elif f.name in to_text:
            c = strip(c.cast("string")).alias(f.name)
        out.append(c)
    return df.select(*out)
