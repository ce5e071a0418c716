"""Toxicity: a linear classifier on character n-grams whose features are
scaled by naive-Bayes log-count ratios, trained on labelled text.

A text is lower-cased; its features are the distinct hashed n-grams (n = 3,
4, 5 code points) it holds. From the labelled rows each feature f gets the
ratio r(f) = log((p(f) + a) / |p + a|) - log((q(f) + a) / |q + a|), where p and q
count the toxic and the other texts that hold f. A logistic regression is fit on
the vectors r * x; the product of both gives one weight per feature, and a
text's score is the logistic function of the weights it holds.

Defined results: NULL or empty texts (and texts shorter than three code
points) hold no feature and score by the bias alone; repeated rows and
repeated ids are scored row by row, ties cannot arise; an empty table gives
no rows; without any labelled row of one class the model falls back to the
(smoothed) share of toxic rows as a constant score. Only the text is an
input of a score. Other columns may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.common import id_text, released, ship_package

SIZES = (3, 4, 5)
BITS = 18
#: At most this many labelled rows of each class are used for the fit (those
#: whose ids hash lowest). The bound keeps the fit at the driver small.
MAX_FIT_ROWS = 1500
FOLDS = 5
#: Weights below this share of the largest are set to zero after the fit.
TINY = 1e-2
#: n-grams whose log-count ratio is nearer to zero tell too little to be kept.
MIN_RATIO = 0.4

_MULT = np.array([2654435761, 2246822519, 3266489917, 668265263, 374761393], dtype=np.uint32)


def ngram_ids(text: str) -> np.ndarray:
    """Hashed n-grams of the lower-cased text, one per position and size."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    shift = np.uint32(32 - BITS)
    out = []
    h = c * _MULT[0]
    for n in range(2, SIZES[-1] + 1):
        if len(c) < n:
            break
        # a running polynomial; the multiplication wraps at 32 bits
        h = (h[: len(c) - n + 1] ^ (h[: len(c) - n + 1] >> np.uint32(15))) * _MULT[1]
        h = h + c[n - 1:] * _MULT[n - 1]
        if n in SIZES:
            out.append(((h ^ (h >> np.uint32(16))) * _MULT[0]) >> shift)
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint32)


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def __post_init__(self) -> None:
        self.used = self.weights != 0  # a small table, looked at before the weights

    def score(self, text: str) -> float:
        ids = ngram_ids(text)
        held = ids[self.used[ids]]
        z = self.bias + float(self.weights[np.unique(held)].sum())
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -500, 500))))


def fit(texts: list[str], labels: list[int], share: float | None = None, alpha: float = 1.0,
        l2: float = 1e-2, steps: int = 100) -> Model:
    """Fit on the given rows. ``share`` is the toxic share among all training
    rows; the bias is moved by the difference to the share in the rows given."""
    y = np.asarray(labels, dtype=np.float64)
    n, pos = len(y), float(np.sum(labels))
    share = (pos + 1) / (n + 2) if share is None else min(max(share, 1e-6), 1 - 1e-6)
    constant = float(np.log(share / (1 - share)))
    if pos == 0 or pos == n:
        return Model(np.zeros(1 << BITS), constant)
    rows = [np.unique(ngram_ids(t)) for t in texts]
    idx = np.concatenate(rows).astype(np.int64)
    row = np.repeat(np.arange(n), [len(r) for r in rows])
    p = alpha + np.bincount(idx, weights=y[row], minlength=1 << BITS)
    q = alpha + np.bincount(idx, weights=1 - y[row], minlength=1 << BITS)
    r = np.log(p / p.sum()) - np.log(q / q.sum())
    # rare features keep a small ratio, so hapaxes cannot decide a text
    seen = p + q - 2 * alpha
    r[(seen < 3) | (np.abs(r) < MIN_RATIO)] = 0.0
    use, inv = np.unique(idx[r[idx] != 0], return_inverse=True)
    keep = r[idx] != 0
    row, val = row[keep], r[use][inv]
    w, b = np.zeros(len(use)), 0.0
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, steps + 1):
        z = np.bincount(row, weights=w[inv] * val, minlength=n) + b
        g = 1 / (1 + np.exp(-np.clip(z, -500, 500))) - y
        gw = np.bincount(inv, weights=g[row] * val, minlength=len(use)) / n + l2 * w
        gb = g.mean()
        m, v = 0.9 * m + 0.1 * gw, 0.99 * v + 0.01 * gw * gw
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        c1, c2 = 1 - 0.9 ** t, 1 - 0.99 ** t
        w -= 0.02 * (m / c1) / (np.sqrt(v / c2) + 1e-8)
        b -= 0.02 * (mb / c1) / (np.sqrt(vb / c2) + 1e-8)
    weights = np.zeros(1 << BITS)
    weights[use] = w * r[use]
    weights[np.abs(weights) < TINY * np.abs(weights).max()] = 0.0
    given = pos / n
    return Model(weights, float(b) + constant - float(np.log(given / (1 - given))))


def _training_rows(docs: DataFrame, labels: DataFrame, max_rows: int, label_col: str):
    """(texts, labels, share): a bounded number of rows of each class and the
    toxic share among all labelled rows outside the held-out fold."""
    lab = (labels.select(F.col("doc_id").cast("long").alias("_id"),
                         F.col(label_col).cast("int").alias("_y"))
           .filter(F.col("_y").isin(0, 1) & F.col("_id").isNotNull()
                   & ~held_out_column(F.col("_id")))
           .groupBy("_id").agg(F.max("_y").alias("_y")))
    counts = {r["_y"]: r["n"] for r in lab.groupBy("_y").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = None
    for y in (0, 1):
        part = (lab.filter(F.col("_y") == y)
                .orderBy(F.xxhash64("_id", F.lit("fit")), "_id").limit(max_rows))
        rows = part if rows is None else rows.unionByName(part)
    # at most 2 * max_rows ids: a proven bound for the broadcast
    chosen = (id_text(docs).join(F.broadcast(rows), "_id")
              .groupBy("_id").agg(F.max("_y").alias("_y"), F.max("_text").alias("_text"))
              .orderBy("_id").collect())
    total = sum(counts.values())
    share = counts.get(1, 0) / total if total else None
    return [r["_text"] for r in chosen], [int(r["_y"]) for r in chosen], share


def held_out_column(id_col: Column, folds: int = FOLDS) -> Column:
    """crc32 of the id as text falls into fold 0 (a NULL id is in none)."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string")), F.lit(folds)) == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_FIT_ROWS,
          label_col: str = "toxic") -> Model:
    """Fit on labelled documents outside the held-out fold; of each class at
    most ``max_rows`` rows are used."""
    texts, ys, share = _training_rows(docs, labels, max_rows, label_col)
    return fit(texts, ys, share)


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with one more column ``_score`` at the end, one row for each row."""
    ship_package(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = held.value
        own = Model(weights, bias)
        for b in batches:
            at = b.schema.get_field_index(text_col)
            scores = [own.score(t or "") for t in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(scores, pa.float64())],
                                             names=[*b.schema.names, "_score"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields,
                                              T.StructField("_score", T.DoubleType())]))


def toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_FIT_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    model = train(docs, labels, max_rows)
    out = score(id_text(docs), model, "_text")
    return out.select(F.col("_id").alias("doc_id"),
                      held_out_column(F.col("_id")).alias("held_out"),
                      F.col("_score").alias("score"),
                      (F.col("_score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_FIT_ROWS) -> DataFrame:
    """The documents that the classifier doesn't reject, with their columns."""
    model = train(docs, labels, max_rows)
    ship_package(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.bias))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*held.value)
        for b in batches:
            stays = [own.score(t or "") < 0.5 for t in b.column(at).to_pylist()]
            yield b.filter(pa.array(stays, pa.bool_()))

    return docs.mapInArrow(released(run), docs.schema)
