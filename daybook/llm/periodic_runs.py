"""Periodic runs: an online sparse diagonal program over words.

A run is a stretch of consecutive words with smallest period q that no
neighbouring word extends, of at least max(least, exponent * q) words. On the
diagonal of lag q (word i beside word i - q) it is an unbroken line of matches.
A word's earlier occurrences increment the match lengths of the lags at which
they stand; a diagonal that ends emits its stretch if it's long enough.

Kept plainly, a frequent word would touch as many diagonals as it has earlier
occurrences, a square in all. So the lags are kept in octaves, and a word counts
with its context: for lags in (k/2, k], k a power of two, occurrences of the k
words that begin at i. In an octave only the latest earlier occurrence can carry
a run. Proof: if k words stand at i and i - d, d < q <= k, both inside a stretch
of period q, then its block of q words equals a rotation of itself and has a
smaller period; so the latest occurrence inside a run of smallest period q has
lag q, at the run's ends too. And a run of exponent 3 or more has k >= q more words
than a context, so no run is without a diagonal. A line of equal latest lags is
thus exactly a run, each word is on at most one active diagonal of an octave,
and contexts that occur once leave the later octaves (those stay sparse).

Contexts are named exactly (pairs of names of half the length, no hashes). The
lines of all words of a batch are followed by array operations.

Defined results: words are separated by white space (space, tab to carriage
return); NULL, empty and blank texts have no words and no runs; a text of any
length is one sequence (arrays of a few integers for each word); ties for the
greatest exponent go to the smaller start, then period; repeated rows and ids
are read row by row; an empty table gives no rows. Other columns may have any
names.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import id_text

LEAST_WORDS = 6
EXPONENT = 4
#: UTF-8 bytes whose words are followed together (a longer text alone).
BATCH_BYTES = 1 << 20

Run = tuple[int, int, int]  # start, length, period
Reader = Callable[[int | None, str], list[bytes]]  # the words of a row

RUNS = ("doc_id long, words long, runs array<struct<start:long,length:long,period:long>>, "
        "collapsed string")


def words_of(doc_id: int | None, text: str) -> list[bytes]:
    """Words in UTF-8: the white space of ``bytes.split`` is exactly that of
    the definition."""
    return text.encode("utf-8", "surrogatepass").split()


def words_with_planted_repeat(doc_id: int | None, text: str) -> list[bytes]:
    """The words; where crc32 of the id is divisible by ten, the words from a
    place on repeat the first ones from there (a NULL id has no checksum)."""
    words = words_of(doc_id, text)
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def find_runs(texts: list[list[bytes]], least: int = LEAST_WORDS,
              exponent: int = EXPONENT) -> list[list[Run]]:
    """The runs of every sequence, by start, then period."""
    if exponent < 3:
        raise ValueError("the octaves need an exponent of 3 or more")
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes)
    n = int(ends[-1]) if len(texts) else 0
    out: list[list[Run]] = [[] for _ in texts]
    if n == 0:
        return out
    number: defaultdict[bytes, int] = defaultdict(count().__next__)
    names = np.fromiter((number[w] for t in texts for w in t), np.int64, n)
    owner = np.repeat(np.arange(len(texts)), sizes)
    # the k words at i end at or before the end of their text
    room = np.repeat(ends, sizes) - np.arange(n)
    longest = int(sizes.max()) // exponent  # no period is longer
    # names are made different from text to text: only contexts of one text are equal
    at, name = np.arange(n), _renamed(owner * len(number) + names)
    k = 1
    while True:
        at, name, lag = _latest(at, name)
        for start, length, period in _lines(at, lag, k):
            if length >= max(least, exponent * period):
                text = int(owner[start])
                out[text].append((start - int(ends[text] - sizes[text]), length, period))
        if k >= longest or len(at) == 0:
            break
        # the context of 2k words is the pair of contexts at i and i + k
        whole = np.full(n + k, -1, dtype=np.int64)
        whole[at] = name
        second = whole[at + k]
        fits = (second >= 0) & (room[at] >= 2 * k)
        at, name = at[fits], _renamed(name[fits] * (int(name.max()) + 1) + second[fits])
        k *= 2
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def _renamed(names: np.ndarray) -> np.ndarray:
    """The same partition into equal names, numbered from 0."""
    return np.unique(names, return_inverse=True)[1].astype(np.int64)


def _latest(at: np.ndarray, name: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Contexts that occur more than once, by place, with the lag to the
    latest earlier occurrence (0: none)."""
    often = np.bincount(name)[name] > 1
    at, name = at[often], name[often]
    order = np.argsort(name, kind="stable")  # by name, then place
    lag = np.zeros(len(at), dtype=np.int64)
    same = name[order][1:] == name[order][:-1]
    lag[order[1:][same]] = at[order[1:][same]] - at[order[:-1][same]]
    return at, name, lag


def _lines(at: np.ndarray, lag: np.ndarray, k: int) -> Iterator[Run]:
    """(start, length, period) of every line of equal lags of the octave of k."""
    held = np.flatnonzero((lag > k // 2) & (lag <= k))
    if len(held) == 0:
        return
    at, lag = at[held], lag[held]
    breaks = np.flatnonzero((np.diff(at) != 1) | (np.diff(lag) != 0)) + 1
    first = np.concatenate([[0], breaks])
    last = np.concatenate([breaks, [len(at)]]) - 1
    begin = at[first] - lag[first]
    yield from zip(begin.tolist(), (at[last] + k - begin).tolist(), lag[first].tolist())


def collapse(words: list[bytes], runs: list[Run]) -> bytes:
    """The words without what a run repeats: of every run its first period stays."""
    if not runs:
        return b" ".join(words)
    kept, at = [], 0
    for a, b in sorted((s + q, s + n) for s, n, q in runs):
        if a > at:
            kept += words[at:a]
        at = max(at, b)
    return b" ".join(kept + words[at:])


def _batches(b: pa.RecordBatch, read: Reader) -> Iterator[tuple[list, list[list[bytes]]]]:
    """Rows of about BATCH_BYTES of text: ids and words."""
    ids, texts, size = [], [], 0
    for i in range(b.num_rows):
        doc_id, text = b.column(0)[i].as_py(), b.column(1)[i].as_py()
        if ids and size + len(text) > BATCH_BYTES:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(doc_id)
        texts.append(read(doc_id, text))
        size += len(text)
    if ids:
        yield ids, texts


def runs(docs: DataFrame, least: int = LEAST_WORDS, exponent: int = EXPONENT,
         read: Reader = words_of) -> DataFrame:
    """doc_id, words, runs, collapsed (the text without what runs repeat)."""
    kinds = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, texts in _batches(b, read):
                found = find_runs(texts, least, exponent)
                rows = [[{"start": s, "length": n, "period": q} for s, n, q in r] for r in found]
                short = [collapse(t, r).decode("utf-8", "replace") for t, r in zip(texts, found)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(map(len, texts), pa.int64()),
                     pa.array(rows, kinds), pa.array(short, pa.string())],
                    names=["doc_id", "words", "runs", "collapsed"])

    return id_text(docs).mapInArrow(run, RUNS)


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the run of greatest exponent (start, length, period,
    exponent_milli), runs_sha256, collapsed_sha256."""
    # exponents are compared by cross products: exact
    better = ("(l, r) -> case "
              "when l.length * r.period != r.length * l.period "
              "then if(l.length * r.period > r.length * l.period, -1, 1) "
              "when l.start != r.start then if(l.start < r.start, -1, 1) "
              "else if(l.period < r.period, -1, if(l.period > r.period, 1, 0)) end")
    best = F.expr(f"get(array_sort(runs, {better}), 0)")
    line = F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
        r["period"].cast("string"), F.lit("\n")))
    return (found.withColumn("_best", best)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"),
                    F.col("_best.start").alias("start"), F.col("_best.length").alias("length"),
                    F.col("_best.period").alias("period"),
                    F.expr("(1000 * _best.length) div _best.period").alias("exponent_milli"),
                    F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
                    F.sha2("collapsed", 256).alias("collapsed_sha256")))
