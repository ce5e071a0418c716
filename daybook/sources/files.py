"""File sources and sinks: raw CSV in, tables (parquet by default) out.

Sinks always write the whole table, schema included, so a re-run is
idempotent. ``publish`` writes to a staging path first, runs the caller's
contract on the staged data and only then makes it the current version, so a
failed contract never replaces a good table and there is a whole one at any time.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from daybook.config import RAW_SCHEMA
from daybook.errors import DataContractError
from daybook.sources.versions import fs_path, publish_version, retain, table_path


def read_raw_csv(spark: SparkSession, path: str, schema: StructType = RAW_SCHEMA) -> DataFrame:
    """Read a headed CSV with a fixed schema. Malformed rows raise (FAILFAST)
    when parsed; header names are checked against the schema
    (``enforceSchema=false``), so a renamed or shifted column raises too."""
    return (
        spark.read.option("header", "true")
        .option("mode", "FAILFAST")
        .option("enforceSchema", "false")
        .schema(schema)
        .csv(path)
    )


#: Column of a parted scan: NULL for a good row, file and text of a malformed one.
REJECT_COL = "_reject"


def read_raw_csv_parted(spark: SparkSession, path: str, schema: StructType = RAW_SCHEMA) -> DataFrame:
    """The same scan with malformed rows kept apart instead of raised: column
    ``_reject`` (file, text) is NULL for a good row. A row is malformed if a cell
    doesn't parse or the number of cells is not the schema's; a header that
    differs still raises."""
    text = "_malformed_text"
    rows = (
        spark.read.option("header", "true")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", text)
        .option("enforceSchema", "false")
        .schema(StructType([*schema, StructField(text, StringType())]))
        .csv(path)
    )
    reject = F.when(F.col(text).isNotNull(), F.struct(F.col("_metadata.file_path").alias("file"),
                                                      F.col(text).alias("text")))
    return rows.select(*schema.names, reject.alias(REJECT_COL))


#: Most rows of a compressed CSV file, which one task reads whole.
CSV_FILE_ROWS = 1_000_000


def write_csv(df: DataFrame, path: str, compression: str | None = None) -> str:
    """Export a table as headed CSV (full overwrite). ``compression``: a codec of
    Spark's (lz4, gzip, ...), in files of at most ``CSV_FILE_ROWS`` rows."""
    writer = df.write.mode("overwrite").option("header", "true")
    if compression is not None:
        writer = writer.option("compression", compression).option("maxRecordsPerFile", CSV_FILE_ROWS)
    writer.csv(path)
    return path


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               version: int | None = None) -> DataFrame:
    """A table, or the current (or given) version of a published one."""
    return spark.read.format(fmt).load(table_path(spark, path, version))


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> int:
    """Full overwrite of ``path``; returns the rows written, measured by an
    ``Observation`` in the same job as the write (no second scan)."""
    obs = Observation("rows_written")
    writer = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").format(fmt)
    if fmt == "delta":
        writer = writer.option("overwriteSchema", "true")
    writer.save(path)
    return int(obs.get["rows"])


def ingest_parted(spark: SparkSession, source: str, target: str, rejects: str,
                  max_share: float = 0.0, schema: StructType = RAW_SCHEMA, fmt: str = "parquet",
                  keep: int | None = None) -> dict[str, int]:
    """Raw CSV into two published tables in one scan: good rows into ``target``,
    malformed ones (file, text) into ``rejects``; returns their numbers.

    The rows are written once, parted by a flag, and counted by an ``Observation`` of the
    same job; the two parts are then moved (not rewritten) into a new version of
    each table, rejects first. More than ``max_share`` malformed rows raise
    ``DataContractError``: both tables keep their versions and the staged rows stay for
    inspection. A part without rows is an empty version."""
    rows = read_raw_csv_parted(spark, source, schema)
    flag = F.col(REJECT_COL).isNotNull()
    obs = Observation("rows_parted")
    staged = os.path.join(target, f"_parted-{uuid.uuid4().hex[:12]}")
    (rows.withColumn("_bad", flag.cast("int"))
     .observe(obs, F.count(F.lit(1)).alias("source_rows"), F.count_if(~flag).alias("good_rows"),
              F.count_if(flag).alias("malformed_rows"))
     .write.partitionBy("_bad").format(fmt).save(staged))
    counts = {k: int(v) for k, v in obs.get.items()}
    if counts["malformed_rows"] > max_share * counts["source_rows"]:
        raise DataContractError("malformed rows", f"more than {max_share:.2%}", counts | {"staged": staged})

    def moved(part: int):
        def write(empty: DataFrame, path: str) -> int:
            fs, src = fs_path(spark, os.path.join(staged, f"_bad={part}"))
            if not fs.exists(src):
                empty.write.format(fmt).save(path)
            elif not fs.rename(src, fs_path(spark, path)[1]):
                raise OSError(f"can't move {src}")
            return counts["malformed_rows" if part else "good_rows"]
        return write

    def check(path: str, n: int) -> None:
        stored = spark.read.format(fmt).load(path).count()
        if stored != n:
            raise DataContractError("malformed rows", "stored rows differ", counts | {"stored": stored})

    empty = rows.limit(0)
    for part, table in ((1, rejects), (0, target)):
        fs, p = fs_path(spark, table)
        fs.mkdirs(p)
        publish_version(empty, table, moved(part), check)
        if keep is not None:
            retain(spark, table, keep)
    fs, p = fs_path(spark, staged)
    fs.delete(p, True)
    return counts


def overwrite_partitions(df: DataFrame, path: str, by: Sequence[str], fmt: str = "parquet") -> str:
    """Write the rows into a table partitioned by ``by``; partitions that occur
    among the rows are replaced, all others stay as they are."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*by).format(fmt).save(path))
    return path


def read_partitions(spark: SparkSession, path: str, by: Sequence[str], fmt: str = "parquet") -> DataFrame:
    """A partitioned table whose partition columns ``by`` are text (a version
    "1" would be read as a number). Filters on them prune folders."""
    found = spark.read.format(fmt).load(path).schema
    schema = StructType([StructField(f.name, StringType()) if f.name in by else f for f in found])
    return spark.read.format(fmt).schema(schema).load(path)


def publish(df: DataFrame, target: str, check: Callable[[DataFrame, int], None] | None = None,
            fmt: str = "parquet", keep: int | None = None) -> int:
    """Stage → check → publish as the target's next version (:mod:`versions`).
    ``check(staged_df, rows_written)`` runs on the stored rows and raises to stop
    the publish; the target then keeps its current version and the staged copy
    stays for inspection. ``keep``: versions that stay. Returns the rows."""
    spark = df.sparkSession

    def checked(path: str, rows: int) -> None:
        check(spark.read.format(fmt).load(path), rows)

    rows, _ = publish_version(df, target, lambda d, path: write_table(d, path, fmt),
                              checked if check is not None else None)
    if keep is not None:
        retain(spark, target, keep)
    return rows
