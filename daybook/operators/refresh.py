"""Refresh of the feature table for changed series only.

The features of a series depend on its own daily rows alone. So the table is stored in
partitions (``bucket``, a hash of the series), beside a fingerprint of each series' daily
rows. A refresh compares the fingerprints of the daily table with the stored ones and builds
and replaces only the partitions that hold a changed, new or deleted series; the
files of all others stay as they are.

The layout under one folder: ``rows/bucket=<k>``, the versions of ``prints`` and of ``shape``
(no rows: the schema), and ``layout`` (the number of partitions). A refresh that ends anywhere is made good by the next one: before a partition is touched, a
version of the fingerprints without its series is published, so that they count as changed until
their new ones are stored. New partitions are written beside the table and checked before they
are moved into place. One refresh runs at a time.

Defined results: a NULL in a series key is a value like any other; rows without a date are kept,
as by the gap filling; rows that repeat count each; an empty daily table empties the feature table.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from daybook.config import SERIES_KEYS
from daybook.operators.timeseries import build_features
from daybook.sources.files import publish, read_table, write_table
from daybook.sources.versions import fs_path, table_exists

BUCKET_COL = "bucket"
#: Partitions of a new table; an existing one keeps its number.
BUCKETS = 256
PRINT_COLUMNS = ["rows", "hash_sum", "hash_xor"]


def bucket_of(series_keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*series_keys), F.lit(buckets)).cast("int")


def series_prints(daily: DataFrame, series_keys: Sequence[str] = SERIES_KEYS,
                  recipe: str = "") -> DataFrame:
    """One row per series: number of its daily rows, and sum and xor of two
    64-bit hashes of them, so neither order nor partitioning matters. Two states that differ
    have equal prints with a chance of about 2^-64 at most. ``recipe`` names the way
    features are made: another one makes all series differ."""
    columns = sorted(daily.columns)
    # the hash skips NULLs, so where they stand is hashed too
    nulls = F.concat(*[F.col(c).isNull().cast("int").cast("string") for c in columns])
    first = F.xxhash64(F.lit(recipe), nulls, *columns)
    second = F.xxhash64(F.lit("second"), first, *reversed(columns))
    return daily.groupBy(*series_keys).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(first.cast("decimal(20,0)")).alias("hash_sum"),
        F.bit_xor(second).alias("hash_xor"))


def changed_series(new: DataFrame, old: DataFrame, series_keys: Sequence[str] = SERIES_KEYS) -> DataFrame:
    """The series whose prints differ, or that only one side has, with ``is_new``
    and ``is_deleted``. One shuffle of prints; NULL keys are matched."""
    value = F.struct(*PRINT_COLUMNS)
    sides = new.select(*series_keys, value.alias("_p"), F.lit(1).alias("_side")).unionByName(
        old.select(*series_keys, value.alias("_p"), F.lit(0).alias("_side")))
    both = sides.groupBy(*series_keys).agg(
        F.min("_p").alias("_lo"), F.max("_p").alias("_hi"),
        F.min("_side").alias("_from"), F.max("_side").alias("_to"))
    return both.filter((F.col("_lo") != F.col("_hi")) | (F.col("_from") == F.col("_to"))).select(
        *series_keys, (F.col("_from") == 1).alias("is_new"), (F.col("_to") == 0).alias("is_deleted"))


def read_features(spark: SparkSession, folder: str, fmt: str = "parquet") -> DataFrame:
    """The feature table without its partition column."""
    schema = read_table(spark, os.path.join(folder, "shape"), fmt).schema
    if read_table(spark, os.path.join(folder, "prints"), fmt).isEmpty():  # no partition is left
        return spark.createDataFrame([], schema)
    return spark.read.format(fmt).load(os.path.join(folder, "rows")).select(*schema.names)


def refresh_features(daily: DataFrame, folder: str, series_keys: Sequence[str] = SERIES_KEYS,
                     build: Callable[[DataFrame], DataFrame] = build_features, recipe: str = "",
                     check: Callable[[DataFrame, int], None] | None = None,
                     buckets: int = BUCKETS, fmt: str = "parquet") -> dict:
    """Bring the feature table under ``folder`` up to date with ``daily``, a stored
    table (it is read twice). ``build`` makes features from the daily rows of whole
    series; ``check(staged, rows)`` runs on the new partitions and raises to stop before any
    is replaced. Returns the counts of series and the partitions replaced."""
    spark = daily.sparkSession
    kept, shape, layout, rows = (os.path.join(folder, n) for n in ("prints", "shape", "layout", "rows"))
    if not table_exists(spark, layout):
        publish(series_prints(daily.limit(0), series_keys, recipe), kept, fmt=fmt)
        publish(spark.range(1).select(F.lit(buckets).alias("buckets")), layout, fmt=fmt)
    buckets = read_table(spark, layout, fmt).head()[0]

    staged = os.path.join(folder, f"_staging-{uuid.uuid4().hex[:12]}")
    new_path = os.path.join(staged, "prints")
    write_table(series_prints(daily, series_keys, recipe), new_path, fmt)
    new, old = read_table(spark, new_path, fmt), read_table(spark, kept, fmt)
    bucket = bucket_of(series_keys, buckets)
    # at most ``buckets`` rows come to the driver
    found = changed_series(new, old, series_keys).groupBy(bucket.alias("b")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_new").alias("new"),
        F.count_if("is_deleted").alias("deleted")).collect()
    touched = sorted(r.b for r in found)
    out = {"buckets": buckets, "replaced": touched, "rows": 0,
           "changed": sum(r.n - r.new - r.deleted for r in found),
           "new": sum(r.new for r in found), "deleted": sum(r.deleted for r in found)}
    built = build(daily.filter(bucket.isin(touched) if touched else F.lit(False)))
    if touched or not table_exists(spark, shape):
        publish(built.limit(0), shape, fmt=fmt, keep=2)
    if touched:
        parts = os.path.join(staged, "rows")
        out["rows"] = _write_parts(built.withColumn(BUCKET_COL, bucket), parts, fmt)
        if check is not None:
            check(spark.read.format(fmt).load(parts).drop(BUCKET_COL) if out["rows"] else built.limit(0),
                  out["rows"])
        publish(old.filter(~bucket.isin(touched)), kept, fmt=fmt)
        for b in touched:
            _replace(spark, os.path.join(parts, f"{BUCKET_COL}={b}"),
                     os.path.join(rows, f"{BUCKET_COL}={b}"))
    publish(new, kept, fmt=fmt, keep=2)
    fs, p = fs_path(spark, staged)
    fs.delete(p, True)
    return out


def _write_parts(df: DataFrame, path: str, fmt: str) -> int:
    """Write the rows in partitions, a file for each; returns their number."""
    obs = Observation("rows_refreshed")
    (df.observe(obs, F.count(F.lit(1)).alias("rows")).repartition(BUCKET_COL)
     .write.partitionBy(BUCKET_COL).format(fmt).save(path))
    return int(obs.get["rows"])


def _replace(spark: SparkSession, new: str, old: str) -> None:
    """Put a new partition in the old one's place; without a new one the old goes."""
    fs, src = fs_path(spark, new)
    _, dst = fs_path(spark, old)
    if fs.exists(dst):
        fs.delete(dst, True)
    if fs.exists(src):
        fs.mkdirs(dst.getParent())
        if not fs.rename(src, dst):
            raise OSError(f"can't move {new}; the next refresh builds it anew")
