"""Gradient boosting of symmetric trees on histograms, in barrier stages.

A tree has one split per level, so a row's leaf is a number of ``depth`` bits.
Inputs are binned once by quantiles and stored. A barrier stage holds the
binned rows in its tasks for ``SEGMENT`` rounds: on every level each task sums
its gradients by leaf, input and bin, all tasks exchange these sums (their size
depends on leaves, inputs and bins, not on rows) and choose the same split.
Between segments the trees are a stored table, from which a restarted fit goes on.

Gradients are rounded to whole multiples of a power of two that is small enough
for all sums to be exact in doubles. So sums don't depend on their order, and
the trees not on the number of tasks or the order of rows. The power follows from
the largest gradient at a segment's start and the values of the trees since.

An exchange takes about a second whatever its size (a barrier task looks for the
others' messages once a second), so a task holds many rows (``TASK_ROWS``, about
what it sums in that time), and a table that fits one task needs no exchange.

Only half of a level's sums are made and sent, those of left children; the
others are differences, exact too. Every message carries the split chosen
before it; tasks that disagree raise.
"""

from __future__ import annotations

import base64
import hashlib
import json
import math
import os
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import BarrierTaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daybook.session import ship_package
from daybook.sources.versions import fs_path

#: Most bins of an input (a bin's number is a byte).
BINS = 64
#: Regularisation of leaf values, in rows (the reference trainer's default).
L2 = 3.0
#: Rounds of one barrier stage; its trees are stored at its end.
SEGMENT = 50
#: Rows of one task, while there are no more tasks than these (messages grow as
#: the square of the tasks).
TASK_ROWS, MAX_TASKS = 2_000_000, 64

TREES = ("iteration int, features array<int>, bins array<int>, borders array<double>, "
         "values array<double>, rows array<long>")


@dataclass(frozen=True)
class BoostSettings:
    iterations: int
    depth: int
    learning_rate: float
    bins: int = BINS
    l2: float = L2


@dataclass(frozen=True)
class Tree:
    features: list[int]
    bins: list[int]
    values: list[float]  # by leaf, learning rate included
    rows: list[int]  # training rows by leaf

    def leaves(self, codes: np.ndarray) -> np.ndarray:
        """The leaf of every row of bin numbers: the first split is the highest bit."""
        leaf = np.zeros(len(codes), dtype=np.int64)
        for f, b in zip(self.features, self.bins):
            leaf = 2 * leaf + (codes[:, f] > b)
        return leaf


# ---- bins ------------------------------------------------------------------------------

def quantile_borders(rows: DataFrame, inputs: Sequence[str], bins: int = BINS) -> list[list[float]]:
    """At most ``bins`` - 1 borders of every input, by one aggregation. An input
    with few values has a border at each; the largest value is no border."""
    shares = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    row = rows.agg(*[F.percentile_approx(c, shares, F.lit(10_000)).alias(f"q{i}")
                     for i, c in enumerate(inputs)],
                   *[F.max(c).alias(f"m{i}") for i, c in enumerate(inputs)]).first()
    return [sorted({v for v in row[f"q{i}"] or [] if v < row[f"m{i}"]}) for i in range(len(inputs))]


def _code_columns(inputs: Sequence[str]) -> list[str]:
    return [f"b{i}" for i in range(len(inputs))]


def binned(rows: DataFrame, inputs: Sequence[str], target: str,
           borders: Sequence[Sequence[float]]) -> DataFrame:
    """(y, b0, b1, ...): the target and for every input the number of borders
    below its value."""
    cols = [F.col(target).cast("double").alias("y")]
    for name, c, edges in zip(_code_columns(inputs), inputs, borders):
        cols.append(_edges_below(F.col(c), edges).cast("short").alias(name))
    return rows.select(*cols)


def _edges_below(value: Column, edges: Sequence[float]) -> Column:
    if not edges:
        return F.lit(0)
    return F.size(F.filter(F.array(*[F.lit(float(e)) for e in edges]), lambda e: e < value))


# ---- one barrier stage -----------------------------------------------------------------

class Exchange:
    """Sums over all tasks of a barrier stage."""

    def __init__(self, context: BarrierTaskContext | None = None):
        self.context = context
        self.tasks = len(context.getTaskInfos()) if context else 1

    def gather(self, *arrays: np.ndarray, note: str = "") -> list[list[np.ndarray]]:
        """The arrays of all tasks, in the order of the tasks."""
        if self.tasks == 1:
            return [list(arrays)]
        raw = b"".join(a.tobytes() for a in arrays)
        got = self.context.allGather(note + "|" + base64.b64encode(raw).decode("ascii"))
        out = []
        for message in got:
            other, body = message.split("|", 1)
            if other != note:
                raise RuntimeError(f"tasks chose different splits: {other} and {note}")
            data, at, parts = base64.b64decode(body), 0, []
            for a in arrays:
                parts.append(np.frombuffer(data, a.dtype, a.size, at).reshape(a.shape))
                at += a.nbytes
            out.append(parts)
        return out

    def total(self, *arrays: np.ndarray, note: str = "") -> list[np.ndarray]:
        got = self.gather(*arrays, note=note)
        return [np.sum([parts[i] for parts in got], axis=0) for i in range(len(arrays))]


class Grower:
    """Grows trees on one task's rows, together with the other tasks."""

    def __init__(self, codes: np.ndarray, y: np.ndarray, borders: Sequence[int],
                 settings: BoostSettings, exchange: Exchange):
        self.codes, self.y, self.settings, self.exchange = codes, y, settings, exchange
        self.bins = max(borders, default=0) + 1
        self.inputs = codes.shape[1]
        # a bin after an input's last border separates nothing
        self.open = np.arange(self.bins)[None, :] < np.asarray(borders)[:, None]
        self.places = [c.astype(np.int64) for c in codes.T]
        self.rows = int(exchange.total(np.array([len(y)], dtype=np.int64))[0][0])
        self.bound: float | None = None  # no gradient is larger

    def _sums(self, leaf: np.ndarray, whole: np.ndarray, leaves: int) -> list[np.ndarray]:
        """Gradients and rows by leaf, input and bin."""
        size = leaves * self.bins
        first = leaf * self.bins
        sums = np.empty((self.inputs, size), dtype=np.float64)
        rows = np.empty((self.inputs, size), dtype=np.int64)
        for f in range(self.inputs):
            key = first + self.places[f] if leaf is not None else self.places[f]
            sums[f] = np.bincount(key, whole, size)
            rows[f] = np.bincount(key, minlength=size)
        shape = (self.inputs, leaves, self.bins)
        return [a.reshape(shape).swapaxes(0, 1) for a in (sums, rows)]

    def grow(self, prediction: np.ndarray) -> tuple[Tree, np.ndarray]:
        """The next tree and the leaf of every row."""
        s = self.settings
        gradient = self.y - prediction
        if self.bound is None:
            self.bound = max(float(p[0].max()) for p in self.exchange.gather(
                np.array([np.abs(gradient).max(initial=0.0)])))
        # all sums of ``rows`` such numbers stay below 2^52
        scale = math.ldexp(1.0, 52 - self.rows.bit_length() - math.frexp(self.bound)[1])
        whole = np.rint(gradient * scale)
        leaf = np.zeros(len(self.y), dtype=np.int64)
        features: list[int] = []
        cuts: list[int] = []
        sums = rows = None
        for level in range(s.depth if self.open.any() else 0):  # without borders: one leaf
            note = f"{features[-1]},{cuts[-1]}" if level else ""
            if level == 0:
                sums, rows = self.exchange.total(*self._sums(leaf, whole, 1), note=note)
            else:
                left = (leaf & 1) == 0
                part = Grower.__new__(Grower)
                part.inputs, part.bins = self.inputs, self.bins
                part.places = [p[left] for p in self.places]
                half = part._sums(leaf[left] >> 1, whole[left], 1 << (level - 1))
                l_sums, l_rows = self.exchange.total(*half, note=note)
                sums = np.stack([l_sums, sums - l_sums], axis=1).reshape(-1, self.inputs, self.bins)
                rows = np.stack([l_rows, rows - l_rows], axis=1).reshape(-1, self.inputs, self.bins)
            f, b = self._best(sums, rows, scale)
            features.append(f)
            cuts.append(b)
            leaf = 2 * leaf + (self.codes[:, f] > b)
        if features:
            g, n = (np.cumsum(a[:, features[-1], :], axis=1) for a in (sums, rows))
            at, last = cuts[-1], self.bins - 1
            g = np.stack([g[:, at], g[:, last] - g[:, at]], axis=1).ravel()
            n = np.stack([n[:, at], n[:, last] - n[:, at]], axis=1).ravel()
        else:
            g, n = self.exchange.total(np.array([whole.sum()]), np.array([len(whole)]))
        values = s.learning_rate * (g / scale) / (n + s.l2)
        self.bound += float(np.abs(values).max())
        return Tree(features, cuts, values.tolist(), n.astype(int).tolist()), leaf

    def _best(self, sums: np.ndarray, rows: np.ndarray, scale: float) -> tuple[int, int]:
        """The split of all leaves with the greatest reduction of squared error;
        ties go to the first input, then bin."""
        l2 = self.settings.l2
        g, n = np.cumsum(sums, axis=2) / scale, np.cumsum(rows, axis=2)
        g_all, n_all = g[:, :, -1:], n[:, :, -1:]
        gain = (g * g / (n + l2) + (g_all - g) ** 2 / (n_all - n + l2)).sum(axis=0)
        gain = np.where(self.open, gain, -np.inf)
        f, b = divmod(int(np.argmax(gain)), self.bins)
        return f, b


def _read_rows(batches: Iterator[pa.RecordBatch], inputs: int) -> tuple[np.ndarray, np.ndarray]:
    ys, codes = [], []
    for b in batches:
        ys.append(b.column(0).to_numpy(zero_copy_only=False))
        codes.append(np.stack([b.column(i + 1).to_numpy(zero_copy_only=False).astype(np.uint8)
                               for i in range(inputs)], axis=1))
    if not ys:
        return np.zeros((0, inputs), dtype=np.uint8), np.zeros(0)
    return np.concatenate(codes), np.concatenate(ys)


def _segment(known: list[Tree], first: int, rounds: int, prior: float,
             borders: list[list[float]], settings: BoostSettings):
    """The barrier stage of ``rounds`` rounds after the known trees."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = BarrierTaskContext.get()
        codes, y = _read_rows(batches, len(borders))
        grower = Grower(codes, y, [len(b) for b in borders], settings, Exchange(context))
        prediction = np.full(len(y), prior)
        for tree in known:
            prediction += np.asarray(tree.values)[tree.leaves(codes)]
        out = []
        for i in range(first, first + rounds):
            tree, leaf = grower.grow(prediction)
            prediction += np.asarray(tree.values)[leaf]
            out.append((i, tree.features, tree.bins,
                        [borders[f][b] for f, b in zip(tree.features, tree.bins)],
                        tree.values, tree.rows))
        if context.partitionId() == 0:  # all tasks have the same trees
            kinds = [pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.float64()),
                     pa.list_(pa.float64()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                names=["iteration", "features", "bins", "borders", "values", "rows"])
    return run


# ---- the fit -----------------------------------------------------------------------------

def read_trees(trees: DataFrame) -> list[Tree]:
    """Trees as values: model metadata, at most ``iterations`` rows."""
    return [Tree(list(r["features"]), list(r["bins"]), list(r["values"]), list(r["rows"]))
            for r in trees.orderBy("iteration").collect()]


def _stored_segments(spark: SparkSession, folder: str) -> list[str]:
    """Whole segments under the folder, in order."""
    out = []
    while True:
        path = os.path.join(folder, f"rounds-{len(out):04d}")
        fs, done = fs_path(spark, os.path.join(path, "_SUCCESS"))
        if not fs.exists(done):
            return out
        out.append(path)


def fit_trees(rows: DataFrame, inputs: Sequence[str], target: str, prior: float,
              settings: BoostSettings, folder: str, segment: int = SEGMENT,
              tasks: int | None = None, stop_after: int | None = None) -> DataFrame:
    """The trees (schema ``TREES``) as a table under ``folder``.

    ``rows``: stored rows whose inputs and target are numbers, none missing. A
    folder may hold segments of an earlier attempt: the fit goes on after them if
    they were made from the same rows with the same settings (other fits have a
    subfolder of their own). ``stop_after``: segments made by this call.
    An empty table, or inputs of one value each, give trees of one leaf.

    A barrier stage needs all its tasks at once, so there are no more than the
    cluster has cores; without dynamic allocation, as Spark demands.
    """
    if not 2 <= settings.bins <= 256:
        raise ValueError(f"bins: {settings.bins}")
    spark = rows.sparkSession
    ship_package(spark)
    borders = quantile_borders(rows, inputs, settings.bins)
    state = rows.agg(F.count(F.lit(1)).alias("n"),
                     F.bit_xor(F.xxhash64(*inputs, target)).alias("x")).first()
    print_of = json.dumps([state["n"], state["x"], float(prior), list(inputs), borders,
                           asdict(settings), segment])
    home = os.path.join(folder, "fit-" + hashlib.sha256(print_of.encode()).hexdigest()[:16])
    if tasks is None:
        tasks = max(1, min(-(-state["n"] // TASK_ROWS), spark.sparkContext.defaultParallelism,
                           MAX_TASKS))
    path = os.path.join(home, "binned")
    fs, done = fs_path(spark, os.path.join(path, "_SUCCESS"))
    if not fs.exists(done):
        binned(rows, inputs, target, borders).write.mode("overwrite").parquet(path)
    dealt = spark.read.parquet(path).repartition(tasks)
    paths, made = _stored_segments(spark, home), 0
    while len(paths) * segment < settings.iterations and made != stop_after:
        first = len(paths) * segment
        known = read_trees(spark.read.schema(TREES).parquet(*paths)) if paths else []
        new = dealt.mapInArrow(_segment(known, first, min(segment, settings.iterations - first),
                                        float(prior), borders, settings), TREES, barrier=True)
        path = os.path.join(home, f"rounds-{len(paths):04d}")
        new.write.mode("overwrite").parquet(path)
        paths.append(path)
        made += 1
    return (spark.read.schema(TREES).parquet(*paths) if paths
            else spark.createDataFrame([], TREES))


def prediction_column(trees: DataFrame, columns: Sequence[Column], prior: float) -> Column:
    """The prediction of every row from its input columns, as an Arrow-fed
    function of whole batches."""
    rows = trees.select("features", "borders", "values", "iteration").orderBy("iteration").collect()
    spark = trees.sparkSession
    ship_package(spark)
    held = spark.sparkContext.broadcast(
        [(list(r["features"]), list(r["borders"]), np.asarray(r["values"])) for r in rows])

    @F.pandas_udf("double")
    def predict(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in parts:
            if isinstance(columns, pd.Series):  # a single input comes alone
                columns = (columns,)
            x = [c.to_numpy(dtype=np.float64) for c in columns]
            out = np.full(len(x[0]), prior)
            for features, borders, values in held.value:
                leaf = np.zeros(len(out), dtype=np.int64)
                for f, b in zip(features, borders):
                    leaf = 2 * leaf + (x[f] > b)
                out += values[leaf]
            yield pd.Series(out)

    return predict(*columns)


def importance_of_trees(trees: DataFrame, names: Sequence[str]) -> DataFrame:
    """(feature, importance): the change of predictions that each input's splits
    make, a share of 100.

    A split parts every pair of leaves that differ in its bit alone. With n1, n2
    training rows and values v1, v2 the pair's weighted variance is
    n1 * n2 / (n1 + n2) * (v1 - v2)^2; an input's importance sums its splits'
    pairs. Inputs without a split have 0; with no change at all, all have.
    """
    split = trees.select(F.posexplode("features").alias("level", "input"),
                         F.size("features").alias("depth"), "values", "rows")
    pair = F.expr("""
        aggregate(filter(sequence(0, size(values) - 1),
                         i -> (i & shiftleft(1, depth - 1 - level)) = 0), 0.0D,
                  (sum, i) -> sum + if(rows[i] + rows[i + shiftleft(1, depth - 1 - level)] = 0, 0.0D,
                      cast(rows[i] as double) * rows[i + shiftleft(1, depth - 1 - level)]
                      / (rows[i] + rows[i + shiftleft(1, depth - 1 - level)])
                      * power(values[i] - values[i + shiftleft(1, depth - 1 - level)], 2)))""")
    change = split.groupBy("input").agg(F.sum(pair).alias("change"))
    listed = trees.sparkSession.createDataFrame(list(enumerate(names)), "input int, feature string")
    # one row for each input: model metadata
    all_rows = listed.join(F.broadcast(change), "input", "left").withColumn(
        "change", F.coalesce("change", F.lit(0.0)))
    total = F.sum("change").over(Window.partitionBy(F.lit(0)))
    return all_rows.select("feature", F.when(total > 0, 100 * F.col("change") / total)
                           .otherwise(0.0).alias("importance"))
