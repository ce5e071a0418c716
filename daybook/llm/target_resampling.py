"""Importance resampling towards a target distribution.

Features are the runs of one to three words, counted in hashed buckets. A bucket
gains by the log ratio of its shares in the target texts and in all documents; a
document's weight is the sum of its features' gains. Adding Gumbel noise from
the id and taking the highest scores draws without replacement, in proportion to
the exponential of the weights.

Scoring works on arrays: words are found in the bytes of many texts at once, and
the checksum of several words comes from those of the words (a checksum is
linear: it is moved over the following bytes by tables).

The cutoff score is found without sorting the table. In each round every
partition tells the median of its remaining keys and their number; the median of
these medians, weighted by the numbers, has at least a quarter of the remaining
keys on either side, so a count of the keys before it discards as many for
certain. Keys that remain are written anew when they have become few. When at
most ``FINISH`` keys remain, they are sorted, and the key at the wanted rank is the
cutoff: exact at every size. Only the winners are sorted, by ranges.

Defined results: NULL, empty and wordless texts have no feature and weight 0; too
short documents are scored but never drawn; ties go to the smaller id (NULL after
all others), rows that repeat id and text are told apart by number; with empty
documents there are no rows, with empty target texts all shares come from the
smoothing; a text of any length is read in windows of ``WINDOW`` bytes. A NULL id draws its
noise as an empty string. Other columns may have any names.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import id_text, ship_package, stored, written

BUCKETS = 10_000
MOST_WORDS = 3
LEAST_WORDS = 20
SEED = 42
#: Bytes of text that are turned into arrays together.
WINDOW = 1 << 20
#: Remaining keys that are sorted at the driver.
FINISH = 4096
#: Words with more bytes are summed one by one.
LONG_WORD = 32

# ---- checksums of word runs ---------------------------------------------------------

# bytes of words: digits, lower-case letters and all bytes beyond ASCII
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_WORD = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)])


def _byte_table() -> np.ndarray:
    """What one byte does to a checksum's state."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1).astype(np.uint32)
    return t


_BYTE = _byte_table()


def _shift_tables(longest: int) -> np.ndarray:
    """[length, which byte of the state, its value]: the state after ``length``
    zero bytes, as the sum of four looked-up parts."""
    part = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * j) for j in range(4)])
    out = [part]
    for _ in range(longest):
        part = _BYTE[part & 255] ^ (part >> 8)
        out.append(part)
    return np.stack(out)


_SHIFT = _shift_tables(LONG_WORD + 1)


def _moved(state: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Checksum states moved over so many bytes."""
    state, length = state.copy(), length.copy()
    while True:
        n = np.minimum(length, LONG_WORD + 1)
        state = (_SHIFT[n, 0, state & 255] ^ _SHIFT[n, 1, (state >> 8) & 255]
                 ^ _SHIFT[n, 2, (state >> 16) & 255] ^ _SHIFT[n, 3, state >> 24])
        length = length - n
        if not length.any():
            return state


def _word_sums(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """crc32 of every word."""
    state = np.full(len(start), 0xFFFFFFFF, dtype=np.uint32)
    short = np.flatnonzero(size <= LONG_WORD)
    order = short[np.argsort(-size[short], kind="stable")]
    sizes = size[order]
    for k in range(int(sizes[0]) if len(sizes) else 0):
        live = order[: np.searchsorted(-sizes, -k, side="left")]  # words of more than k bytes
        state[live] = _BYTE[(state[live] ^ data[start[live] + k]) & 255] ^ (state[live] >> 8)
    state ^= np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(size > LONG_WORD):
        state[i] = zlib.crc32(data[start[i]:start[i] + size[i]].tobytes())
    return state


def _window_buckets(data: np.ndarray, owner_ends: np.ndarray, buckets: int,
                    new_from: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of every feature, its text, words of each text). ``data``: lower-cased bytes
    in which texts end at ``owner_ends``, after a byte that is in no word. Features
    that end before word ``new_from`` were counted in the window before."""
    inside = np.concatenate([[False], _WORD[data], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, size = edges[::2], edges[1::2] - edges[::2]
    text = np.searchsorted(owner_ends, start, side="right")
    sums = _word_sums(data, start, size)
    # the sum of " word": a blank goes before
    blank = np.full(len(start), zlib.crc32(b" "), dtype=np.uint32)
    spaced = _moved(blank, size) ^ sums
    found, texts, run = [sums[new_from:]], [text[new_from:]], sums
    for n in range(1, MOST_WORDS):
        if len(start) <= n:
            break
        run = _moved(run[:-1], size[n:] + 1) ^ spaced[n:]
        together = text[n:] == text[:-n]
        together[: max(0, new_from - n)] = False
        found.append(run[together])
        texts.append(text[n:][together])
    words = np.bincount(text[new_from:], minlength=len(owner_ends))
    return (np.concatenate(found).astype(np.int64) % buckets, np.concatenate(texts), words)


def text_features(texts: list[str], buckets: int = BUCKETS
                  ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Windows over the texts: (bucket of every feature, number of its text,
    words of each text in the window)."""
    held: list[bytes] = []
    numbers: list[int] = []
    size = 0

    def flush():
        data = np.frombuffer(b" ".join([*held, b""]), dtype=np.uint8)
        ends = np.cumsum([len(t) + 1 for t in held])
        found, text, words = _window_buckets(data, ends, buckets)
        whole = np.zeros(len(texts), dtype=np.int64)
        whole[numbers] = words
        return found, np.asarray(numbers)[text] if len(text) else text, whole

    for i, t in enumerate(texts):
        raw = t.encode("utf-8", "surrogatepass").translate(_LOWER)
        if len(raw) > WINDOW:
            yield from _long_text(raw, i, len(texts), buckets)
            continue
        if held and size + len(raw) > WINDOW:
            yield flush()
            held, numbers, size = [], [], 0
        held.append(raw)
        numbers.append(i)
        size += len(raw) + 1
    if held:
        yield flush()


def _long_text(raw: bytes, number: int, texts: int, buckets: int):
    """One long text in windows that end between words; each begins with the last
    words of the one before, whose features aren't counted again."""
    at, carried = 0, []
    data = np.frombuffer(raw, dtype=np.uint8)
    while at < len(raw):
        end = min(at + WINDOW, len(raw))
        while end < len(raw):  # not within a word: on to the next byte that is in none
            gap = np.flatnonzero(~_WORD[data[end:end + WINDOW]])
            if len(gap):
                end += int(gap[0])
                break
            end = min(end + WINDOW, len(raw))
        part = b" ".join([*carried, raw[at:end], b""])
        window = np.frombuffer(part, dtype=np.uint8)
        found, text, words = _window_buckets(window, np.array([len(part)]), buckets, len(carried))
        whole = np.zeros(texts, dtype=np.int64)
        whole[number] = int(words.sum())
        yield found, np.full(len(found), number, dtype=np.int64), whole
        carried = _last_words(window, MOST_WORDS - 1)
        at = end


def _last_words(data: np.ndarray, n: int) -> list[bytes]:
    inside = np.concatenate([[False], _WORD[data], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])[-2 * n:]
    return [data[a:b].tobytes() for a, b in zip(edges[::2], edges[1::2])]


# ---- counts, gains, scores --------------------------------------------------------------


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) over all texts; each task hands on one row for each bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for b in batches:
            for part in _parts(b):
                for found, *_ in text_features(part.column(1).to_pylist(), buckets):
                    total += np.bincount(found, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held], pa.int64())],
                                         names=["bucket", "n"])

    return texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def _parts(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in parts of about WINDOW bytes of text (a longer text alone)."""
    sizes = pc.binary_length(b.column(1)).to_numpy(zero_copy_only=False)
    first, held = 0, 0
    for i, n in enumerate(sizes):
        if i > first and held + n > WINDOW:
            yield b.slice(first, i - first)
            first, held = i, 0
        held += int(n)
    if b.num_rows > first:
        yield b.slice(first)


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of the smoothed shares, floors."""
    buckets = len(raw)
    s, t = raw.astype(np.float64), target.astype(np.float64)
    big_s, big_t = float(raw.sum() + buckets), float(target.sum() + buckets)
    return np.array([math.floor(1000 * math.log((b + 1) * big_s / ((a + 1) * big_t)))
                     for a, b in zip(s, t)], dtype=np.int64)


def _array_of(counts: DataFrame, buckets: int) -> np.ndarray:
    out = np.zeros(buckets, dtype=np.int64)
    for r in counts.collect():  # at most ``buckets`` rows
        out[r["bucket"]] = r["n"]
    return out


def scores(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score of every document."""
    texts, aim = id_text(docs), id_text(target, target.columns[0])
    gain = gains(_array_of(bucket_counts(texts, buckets), buckets),
                 _array_of(bucket_counts(aim, buckets), buckets))
    held = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = held.value
        for b in batches:
            for part in _parts(b):
                n = part.num_rows
                weight, features, words = (np.zeros(n, dtype=np.int64) for _ in range(3))
                for found, text, w in text_features(part.column(1).to_pylist(), buckets):
                    features += np.bincount(text, minlength=n)
                    # sums of integers: exact in doubles up to 2^53
                    weight += np.bincount(text, gain[found], n).astype(np.int64)
                    words += w
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(c, pa.int64()) for c in (words, features, weight))],
                    names=["doc_id", "n_words", "n_features", "weight"])

    rows = texts.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")
    noise = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(noise, 1, 8), 16, 10).cast("long")
    gumbel = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    return rows.withColumn("score", F.col("weight") + gumbel.cast("long"))


# ---- selection ---------------------------------------------------------------------------

Key = tuple[int, int, int]  # -score, id, number: smaller ones are drawn first
_MAX = 2**63 - 1


_KEYS = ("k0", "k1", "k2")


def _row() -> Column:
    return F.struct(*_KEYS)


def _literal(key: Key) -> Column:
    return F.struct(*(F.lit(v).cast("long").alias(c) for v, c in zip(key, _KEYS)))


def _keys(b: pa.RecordBatch) -> np.ndarray:
    """(n, 3) in the order of the keys."""
    rows = np.stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(3)], axis=1)
    return rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]


def _between(keys: DataFrame, low: Key | None, high: Key | None) -> DataFrame:
    """Keys after ``low`` and not after ``high``; the first column alone prunes
    the scan."""
    if low is not None:
        keys = keys.filter(F.col("k0") >= low[0]).filter(_row() > _literal(low))
    if high is not None:
        keys = keys.filter(F.col("k0") <= high[0]).filter(_row() <= _literal(high))
    return keys


def _medians(keys: DataFrame, pivot: Key | None) -> list:
    """For each partition and side of the pivot (1: after it): number of keys and
    their lower median. One row for each partition and side, whatever the rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [_keys(b) for b in batches if b.num_rows]
        out = []
        if rows:
            all_rows = np.concatenate(rows)
            if pivot is None:
                sides = [(0, all_rows)]
            else:
                p = np.array(pivot)
                after = np.zeros(len(all_rows), dtype=bool)
                equal = np.ones(len(all_rows), dtype=bool)
                for j in range(3):
                    after |= equal & (all_rows[:, j] > p[j])
                    equal &= all_rows[:, j] == p[j]
                sides = [(0, all_rows[~after]), (1, all_rows[after])]
            for side, part in sides:
                if len(part):
                    part = part[np.lexsort((part[:, 2], part[:, 1], part[:, 0]))]
                    out.append((side, len(part), *part[(len(part) - 1) // 2].tolist()))
        columns = list(zip(*out)) or [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                         names=["side", "n", "m0", "m1", "m2"])

    return keys.mapInArrow(run, "side long, n long, m0 long, m1 long, m2 long").collect()


def weighted_median(medians: list[tuple[Key, int]]) -> Key:
    """The first key, in order, up to which half of the weight lies."""
    total, so_far = sum(n for _, n in medians), 0
    for key, n in sorted(medians):
        so_far += n
        if 2 * so_far >= total:
            return key
    raise ValueError("no keys")


def cutoff(keys: DataFrame, rank: int, finish: int = FINISH) -> tuple[Key | None, list[int]]:
    """(the key of that rank, from 1; the remaining keys before each round).
    ``keys``: k0, k1, k2, distinct, in a stored table."""
    low: Key | None = None
    high: Key | None = None
    pivot: Key | None = None
    rounds: list[int] = []
    kept = None  # keys of the stored table that is read
    found = [r for r in _medians(keys, None)]
    remaining = sum(r["n"] for r in found)
    if rank < 1 or remaining < rank:
        return None, rounds
    while remaining > finish:
        rounds.append(remaining)
        kept = kept or remaining
        pivot = weighted_median([((r["m0"], r["m1"], r["m2"]), r["n"]) for r in found])
        sides = _medians(_between(keys, low, high), pivot)
        first = sum(r["n"] for r in sides if r["side"] == 0)
        if rank <= first:
            high, remaining = pivot, first
        else:
            low, rank, remaining = pivot, rank - first, remaining - first
        found = [r for r in sides if (r["side"] == 0) == (high is pivot)]
        if remaining * 8 < kept and remaining > finish:
            keys, kept = written(_between(keys, low, high), "selection-keys"), remaining
    rounds.append(remaining)
    last = sorted((r["k0"], r["k1"], r["k2"]) for r in _between(keys, low, high).collect())
    return last[rank - 1], rounds


def draw(scored: DataFrame, share: tuple[int, int] = (5, 100), least_words: int = LEAST_WORDS,
         finish: int = FINISH) -> DataFrame:
    """``scored`` (doc_id, n_words, score) with ``rank``: the highest scores of the
    long enough documents, floor(share) of their number; others NULL."""
    spark = scored.sparkSession
    columns = scored.columns
    rows = written(scored.withColumns({"k0": -F.col("score"), "k1": F.coalesce("doc_id", F.lit(_MAX)),
                                       "k2": F.monotonically_increasing_id()}), "scored")
    long_enough = F.col("n_words") >= least_words
    n = rows.filter(long_enough).count()
    last, _ = cutoff(rows.filter(long_enough).select(*_KEYS), share[0] * n // share[1], finish)
    if last is None:
        return rows.select(*columns, F.lit(None).cast("long").alias("rank"))
    drawn = long_enough & (_row() <= _literal(last))
    winners = stored(rows.filter(drawn).repartitionByRange(
        int(spark.conf.get("spark.sql.shuffle.partitions")), *_KEYS)
        .sortWithinPartitions(*_KEYS).withColumns({"_part": F.spark_partition_id(),
                                                   "_place": F.monotonically_increasing_id()}))
    # rows of a partition are numbered in order: its number is in the upper bits
    place = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    before, first = 0, {}
    for r in sorted(winners.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect(),
                    key=lambda r: r["_part"]):  # one row for each partition
        first[r["_part"]] = before
        before += r["n"]
    offset = F.element_at(F.create_map(*(F.lit(x).cast("long") for kv in first.items() for x in kv)),
                          F.col("_part").cast("long"))
    ranked = winners.select(*columns, (offset + place + 1).alias("rank"))
    return ranked.unionByName(rows.filter(~drawn).select(
        *columns, F.lit(None).cast("long").alias("rank")))


def resample(docs: DataFrame, target: DataFrame, share: tuple[int, int] = (5, 100),
             least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank of every document."""
    ship_package(docs.sparkSession)
    return draw(scores(docs, target, seed=seed), share, least_words)


def digest(drawn: DataFrame) -> DataFrame:
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")
