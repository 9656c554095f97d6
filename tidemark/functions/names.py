"""Column names: key lists, header cleaning and quoting."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F


def split_list(text: str) -> list[str]:
    """``"Client, Order,Item"`` -> ``["Client", "Order", "Item"]``."""
    return [part.strip() for part in text.split(",") if part.strip()]


def quote(name: str) -> str:
    """Backtick a name so that dots, blanks and quotes in it stay literal."""
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    return F.col(quote(name))


def columns(names) -> list[Column]:
    return [column(n) for n in names]


def clean_header(name: str) -> str:
    """Drop line breaks, strip, and fold runs of three or more blanks into one."""
    return re.sub(r"\s{3,}", " ", name.replace("\n", "").strip())


def clean_headers(df: DataFrame) -> DataFrame:
    """The same cleaning for the data that the column catalog gets, so that both agree on names."""
    names = [clean_header(n) for n in df.columns]
    folded = [n.lower() for n in names]
    clash = sorted({n for n in names if folded.count(n.lower()) > 1})
    if clash:
        raise ValueError(f"column names collide after cleaning: {clash}")
    return df.toDF(*names)


def project(df: DataFrame, col_names: str | None) -> DataFrame:
    """``*``, ``-`` and empty mean every column; anything else is a comma-separated list."""
    if col_names is None or col_names.strip() in ("", "*", "-"):
        return df
    return df.select(*columns(split_list(col_names)))


def project_keys(df: DataFrame, primary_key: str) -> DataFrame:
    return df.select(*columns(split_list(primary_key)))
