"""Quality classifier: importance resampling with hashed n-gram models.

Words and word pairs are hashed into buckets. Two bags of buckets are counted:
the target's (documents labelled good) and the raw corpus' (all documents). A
document's weight is the logarithm of the ratio of the two models'
probabilities of its n-grams. Documents are sampled without replacement by
Gumbel top-k: weight plus Gumbel noise drawn from the id, the k largest stay.
k is the share of good ones among the labelled rows, of all documents.

The k-th largest key is found by histograms of the stored keys, each over the
bin that holds it, so no task sorts more than ``LAST_BIN`` keys.

Defined results: NULL or empty texts hold no n-gram and weigh 0; repeated rows
draw the same noise; ties of keys go by id, NULL ids last; an empty table
gives no rows; without labelled rows of both kinds every weight is 0 or the
share falls back to one half. Texts are read whole. Other columns may have
any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import id_text, stored
from daybook.llm.jaccard import WordHashes, mix

BITS = 14
#: Labelled good documents that the target model is counted on, at most.
MAX_TARGET_ROWS = 5000
#: Keys of the last histogram bin that one task may sort.
LAST_BIN = 10_000
SEED = 11

_PAIR = np.uint64(0xD6E8FEB86659FD93)
_SHIFT = np.uint64(64 - BITS)


def buckets(text: str, hashes: dict) -> np.ndarray:
    """Buckets of the text's words and word pairs, with repeats."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    h = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    pairs = h[:-1] * _PAIR + h[1:] * np.uint64(3)
    return (mix(np.concatenate([h, pairs])) >> _SHIFT).astype(np.int64)


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """How often each bucket occurs in all texts (one dense row from each
    task, summed by bucket)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, total = WordHashes(), np.zeros(1 << BITS, dtype=np.int64)
        for b in batches:
            for text in b.column(0).to_pylist():
                total += np.bincount(buckets(text, hashes), minlength=1 << BITS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    rows = (texts.select("_text").mapInArrow(run, "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")).collect())  # at most 2^BITS rows
    out = np.zeros(1 << BITS, dtype=np.int64)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def log_ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """log(target / raw) by bucket, with one count added everywhere."""
    if not target.sum():
        return np.zeros(len(target))
    t, r = target + 1.0, raw + 1.0
    return np.log(t / t.sum()) - np.log(r / r.sum())


def weighted(docs: DataFrame, ratio: np.ndarray) -> DataFrame:
    """doc_id, log_weight of every document."""
    held = docs.sparkSession.sparkContext.broadcast(ratio)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in batches:
            weights = [float(held.value[buckets(t, hashes)].sum()) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(weights, pa.float64())],
                                             names=["doc_id", "log_weight"])

    return id_text(docs).mapInArrow(run, "doc_id long, log_weight double")


def gumbel(id_col: str, seed: int = SEED):
    """Standard Gumbel noise from a hash of the id."""
    u = (F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    return -F.log(-F.log(u))


def top_k(df: DataFrame, k: int, key: str = "key", last_bin: int = LAST_BIN,
          bins: int = 1024) -> DataFrame:
    """The k rows with the largest keys (ties by doc_id, NULLs last)."""
    if k <= 0:
        return df.limit(0)
    lo, hi, total = df.agg(F.min(key), F.max(key), F.count(F.lit(1))).first()
    if total <= k:
        return df
    left, inside = k, total  # rows still wanted of those in [lo, hi]
    while inside > last_bin and lo < hi:
        width = (hi - lo) / bins
        if not lo < lo + width < hi:
            break
        part = df.filter(F.col(key).between(lo, hi))
        number = F.least(F.floor((F.col(key) - lo) / width), F.lit(bins - 1))
        found = (part.groupBy(number.alias("bin"))
                 .agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi"))
                 .orderBy(F.desc("bin")).collect())  # at most ``bins`` rows
        for r in found:
            if r["n"] >= left:
                break
            left -= r["n"]
        lo, hi, inside = r["lo"], r["hi"], r["n"]
    edge = df.filter(F.col(key).between(lo, hi))
    if lo == hi and inside > last_bin:  # one key: the ids decide, found the same way
        if left < inside:
            edge = top_k(edge.withColumn("_order", -F.coalesce("doc_id", F.lit(1 << 62))), left,
                         "_order", inside + 1, bins).drop("_order")
    else:
        edge = edge.orderBy(F.desc(key), F.asc_nulls_last("doc_id")).limit(left)
    return df.filter(F.col(key) > hi).unionByName(edge)


def resample(docs: DataFrame, labels: DataFrame, max_target_rows: int = MAX_TARGET_ROWS,
             seed: int = SEED) -> DataFrame:
    """doc_id, log_weight, key of the sampled documents."""
    texts = id_text(docs)
    lab = (labels.select(F.col("doc_id").cast("long").alias("_id"),
                         F.col("quality").cast("int").alias("_y"))
           .filter(F.col("_id").isNotNull() & F.col("_y").isin(0, 1)))
    n, good = lab.agg(F.count(F.lit(1)), F.sum("_y")).first()
    share = (good or 0) / n if n else 0.5
    # at most max_target_rows ids: a proven bound for the broadcast
    chosen = (lab.filter("_y = 1").select("_id").distinct()
              .orderBy(F.xxhash64("_id", F.lit(seed)), "_id").limit(max_target_rows))
    target = bucket_counts(texts.join(F.broadcast(chosen), "_id", "left_semi"))
    ratio = log_ratio(target, bucket_counts(texts))
    keyed = stored(weighted(docs, ratio).withColumn("key", F.col("log_weight") + gumbel("doc_id", seed)))
    return top_k(keyed, round(share * keyed.count()))
