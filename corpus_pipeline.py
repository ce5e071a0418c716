"""The corpus pipeline: documents to packed sequences, a table for each stage.

Every stage takes the documents that its predecessor kept and returns those it
keeps, with the columns of ``documents``; the last one returns the packed
pieces. Each result is written to the shared folder as Parquet and read again,
so a lost executor costs at most part of one stage. Texts go to Python workers in
small batches, and workers give their memory back between stages.

Defined results: a NULL text is kept by the first four stages as NULL, empty texts
as empty (neither is toxic, a near copy, contaminated or secret by itself; the
classifier's bias decides on both alike), and packed as one end id each; a NULL id
is a row like any other; of rows that repeat id and text one stays after the join; ties
between copies go to the least id; very long texts pass whole; an empty table
gives no rows; other columns pass unchanged under any names, but ``n_chars``,
which is counted anew where texts may change.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import decontaminate, jaccard, packing, secrets, toxicity
from daybook.llm.common import read_table, small_batches
from daybook.session import staging_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _recounted(docs: DataFrame) -> DataFrame:
    """n_chars of texts that may have changed."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.length("text").cast(kind))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go."""
    small_batches(spark)
    return toxicity.drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the least id stays."""
    small_batches(spark)
    return jaccard.one_of_each_group(docs)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark are cut out of the texts."""
    small_batches(spark)
    return _recounted(decontaminate.remove_windows(docs, read_table(spark, sf_dir, "benchmark")))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a marker."""
    small_batches(spark)
    return _recounted(secrets.redact(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining texts as packed pieces of token ids."""
    small_batches(spark)
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("jaccard_join", drop_near_copies),
    ("decontamination", cut_benchmark),
    ("secret_scan", redact_secrets),
    ("packing", pack),
]

# No SQL: a trained classifier and a tokenizer have none. The stages are tested
# against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = staging_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
