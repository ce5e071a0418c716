"""Cleaning: one row per transaction, text dates parsed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.config import DATE_COL, DATE_FORMAT, ID_COL


def dedupe_by_key(df: DataFrame, key: str | Sequence[str] = ID_COL,
                  order_by: Sequence[str] | None = None,
                  columns: Sequence[str] | None = None) -> DataFrame:
    """Keep one row per key value. NULL keys form one group.

    The survivor is the first row in ascending order of ``order_by``
    (default: every column in table order, NULLs first), so it does not
    depend on partitioning and repeats across runs.

    Expressed as a grouped ``min`` over a struct of the row: Spark runs a
    partial aggregate before the shuffle, so the copies of one key are
    reduced inside each map task. A key holding a third of all rows thus
    sends one row per map task, never its whole group, to one reducer.

    ``columns``: those of the survivor that are returned (default: all). The
    order is lexicographic, so what comes after the last of them can't change
    their values: it's neither compared nor shuffled.
    """
    keys = [key] if isinstance(key, str) else list(key)
    cols = df.columns
    # the key is equal inside a group, so it is left out of the compared row
    order = [c for c in (order_by or cols) if c not in keys]
    compared = order + [c for c in cols if c not in order and c not in keys]
    out = cols if columns is None else list(columns)
    last = max((compared.index(c) for c in out if c not in keys), default=-1)
    if columns is not None:
        compared = compared[:last + 1]
    if not compared:
        return df.select(*keys).distinct().select(*out)
    row = F.struct(*[F.col(c) for c in compared])
    return df.groupBy(*keys).agg(F.min(row).alias("_row")).select(
        *[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in out]
    )


def parse_date_col(col: str | F.Column, fmt: str = DATE_FORMAT) -> F.Column:
    """Text → date; malformed or impossible dates become NULL (not an error,
    so they can be counted and rejected by a contract)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.try_to_date(c, fmt)


def parse_dates(df: DataFrame, col: str = DATE_COL, fmt: str = DATE_FORMAT) -> DataFrame:
    return df.withColumn(col, parse_date_col(col, fmt))


def to_silver(raw: DataFrame, key: str = ID_COL, date_col: str = DATE_COL) -> DataFrame:
    """Raw → clean: dedupe by id, then parse the date text."""
    return parse_dates(dedupe_by_key(raw, key), date_col)
