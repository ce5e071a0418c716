"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import gc
import hashlib
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.session import ensure_checkpoint_dir, ship_package, staging_path

__all__ = ["cut_spans", "id_text", "merge_spans", "read_table", "release_shuffles", "rows_by_id",
           "released", "sha256_hex", "ship_package", "small_batches", "stored", "written"]
#: Rows and bytes of the batches that texts go to Python workers in.
BATCH_ROWS, BATCH_BYTES = 512, "4m"
_ROWS_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"
_BYTES_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session by ``BATCH_ROWS`` and
    ``BATCH_BYTES``, unless it has settings of its own: both sides hold a batch whole,
    and Spark's defaults let one of long texts reach 64 MB."""
    for key, default, value in ((_ROWS_CONF, "10000", str(BATCH_ROWS)),
                                (_BYTES_CONF, "67108864b", BATCH_BYTES)):
        if spark.conf.get(key, default) == default:
            spark.conf.set(key, value)


def released(run: Callable) -> Callable:
    """``run`` (batches to batches) for a Python worker that gives its free memory
    back when a task ends. Workers are used again by later stages and would keep
    the largest stage's memory otherwise."""
    def task(batches):
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):  # another C library
                pass
    return task


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text (NULL text becomes empty), under the names
    ``_id`` and ``_text``: other columns of the table can then clash with
    nothing an operator makes."""
    ship_package(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))


def stored(df: DataFrame) -> DataFrame:
    """The rows, written once to the shared checkpoint folder and read back:
    lineage is cut, and a lost executor costs a re-read, not a recomputation."""
    ensure_checkpoint_dir(df.sparkSession)
    out = df.checkpoint(eager=True)
    # plans that are done, with their broadcast tables, stay at the driver as
    # long as this process refers to them
    gc.collect()
    return out


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder. For loops: a
    checkpoint hands its plan's constraints on to the next round, whose number
    multiplies from round to round; a table read back has none."""
    path = staging_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """Let the context cleaner delete the shuffle files of plans that nothing
    refers to any more (it acts on the driver's garbage collection, which a
    mostly idle driver heap may not run for a long time)."""
    gc.collect()  # this side's references first
    spark.sparkContext._jvm.System.gc()


def rows_by_id(docs: DataFrame, wanted: DataFrame, buckets: int = 1 << 18) -> DataFrame:
    """The rows of ``docs`` (``_id``, ``_text``) whose id is among ``wanted``'s
    (``_want``, distinct; NULL finds NULL), with the columns of both. A table
    of at most ``buckets`` hash buckets, a proven bound, keeps most other texts
    out of the shuffle."""
    bucket = (lambda c: F.pmod(F.xxhash64(c), F.lit(buckets).cast("long")))
    marked = wanted.select(bucket("_want").alias("_bucket")).distinct()
    near = (docs.withColumn("_bucket", bucket("_id"))
            .join(F.broadcast(marked), "_bucket", "left_semi").drop("_bucket"))
    return near.join(wanted, near["_id"].eqNullSafe(wanted["_want"]))


def sha256_hex(s: str) -> str:
    return hashlib.sha256(s.encode("utf-8")).hexdigest()


def merge_spans(spans: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of half-open intervals: sorted, disjoint, touching ones joined."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            if e > out[-1][1]:
                out[-1] = (out[-1][0], e)
        elif e > s:
            out.append((s, e))
    return out


def cut_spans(text: str, spans: Sequence[tuple[int, int]], marker: str = " ") -> str:
    """``text`` with every (merged) span replaced by ``marker``."""
    parts, at = [], 0
    for s, e in merge_spans(spans):
        parts += [text[at:s], marker]
        at = e
    return "".join([*parts, text[at:]])
