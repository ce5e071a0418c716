"""Benchmark decontamination: an FM-index per training shard.

Words are the runs of letters and digits of the text with A-Z lower-cased.
Test items are cut into windows of ten consecutive words (a shorter item is
one window). A training shard (a bounded number of documents' words) is
indexed over the words that occur in the items: a suffix array gives the
Burrows-Wheeler transform, a wavelet matrix over it answers ranks, and some
suffix positions are kept. All windows are searched backwards at once;
their occurrences are located by walking to the next kept position; the
words that they cover are merged into removal spans.

Words of no item cannot be part of a match. The index replaces each run of
them by one separator, and stretches shorter than the shortest window are
left out, since no window fits into them; nothing else is.

Defined results: NULL or empty texts have no words and no hits; items without
words have no windows; repeated items and ids count as one id, an item with a
NULL id marks words but has no id to list; repeated rows are judged row by
row; an empty table on either side gives no rows or no hits. Texts of any
length are indexed whole (long ones in slices that overlap by the longest
window). Other columns may have any names.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import cut_spans, id_text, released, sha256_hex, ship_package, written

WINDOW = 10
#: Words that one index holds at most.
SHARD_WORDS = 1 << 20
#: Every so many-th suffix position is kept.
SAMPLE = 16
#: Bytes of test items that pass through the driver and are broadcast at once.
PHRASE_BYTES = 32 << 20
#: Words of an item that stay together in a block.
SLICE_WORDS = 1 << 14

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower_ascii(text: str) -> str:
    """A-Z lower-cased, every other code point as it is."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def words_of(text: str) -> list[str]:
    return _WORD.findall(lower_ascii(text))


# ---- the index ---------------------------------------------------------------

def suffix_array(s: np.ndarray) -> np.ndarray:
    """Start positions of the suffixes in order (prefix doubling). Separators
    count as different symbols, each less than the next, so that repeated
    stretches are told apart at their ends."""
    n = len(s)
    gaps = s == 0
    rank = np.where(gaps, np.cumsum(gaps) - 1, s.astype(np.int64) + gaps.sum())
    rank = np.unique(rank, return_inverse=True)[1].astype(np.int64)
    step = 1
    while True:
        second = np.zeros(n, dtype=np.int64)
        second[: n - step] = rank[step:] + 1
        key = rank * (n + 1) + second
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        fresh = np.empty(n, dtype=np.int64)
        fresh[order] = np.cumsum(np.concatenate([[0], sorted_key[1:] != sorted_key[:-1]]))
        rank, step = fresh, step * 2
        if rank[order[-1]] == n - 1 or step >= n:
            return order


class WaveletMatrix:
    """Ranks of any symbol in a prefix of a sequence, a level for each bit."""

    def __init__(self, s: np.ndarray, sigma: int):
        self.levels = max(1, int(sigma - 1).bit_length())
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        for level in reversed(range(self.levels)):
            bit = ((s >> level) & 1).astype(bool)
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]).astype(np.int32))
            self.zeros.append(int(len(s) - bit.sum()))
            s = np.concatenate([s[~bit], s[bit]])

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often symbol[i] occurs before position end[i], for all i."""
        lo, hi = np.zeros_like(end), end.copy()
        for ones, zeros, level in zip(self.ones, self.zeros, reversed(range(self.levels))):
            one = ((symbol >> level) & 1).astype(bool)
            a, b = ones[lo], ones[hi]
            lo = np.where(one, zeros + a, lo - a)
            hi = np.where(one, zeros + b, hi - b)
        return hi - lo

    def access(self, at: np.ndarray) -> np.ndarray:
        """The symbols at the positions."""
        out, p = np.zeros_like(at), at.copy()
        for ones, zeros in zip(self.ones, self.zeros):
            a = ones[p]
            one = (ones[p + 1] - a).astype(bool)
            out = out * 2 + one
            p = np.where(one, zeros + a, p - a)
        return out


class FMIndex:
    """Backward search over a sequence of symbols >= 1; 0 separates."""

    def __init__(self, s: np.ndarray, sigma: int, sample: int = SAMPLE):
        order = suffix_array(s)
        last = s[order - 1]  # position 0 is preceded by the last symbol, a separator
        self.wavelet = WaveletMatrix(last.astype(np.int64), sigma)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(s, minlength=sigma))])
        kept = (order % sample == 0) | (last == 0)
        self.kept = kept
        self.kept_before = np.concatenate([[0], np.cumsum(kept)])
        self.positions = order[kept]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges [lo, hi) of phrases of one length (a row for each)."""
        lo = np.zeros(len(phrases), dtype=np.int64)
        hi = np.full(len(phrases), len(self.kept), dtype=np.int64)
        live = np.arange(len(phrases))
        for at in reversed(range(phrases.shape[1])):
            symbol = phrases[live, at].astype(np.int64)
            lo[live] = self.first[symbol] + self.wavelet.rank(symbol, lo[live])
            hi[live] = self.first[symbol] + self.wavelet.rank(symbol, hi[live])
            live = live[lo[live] < hi[live]]
            if not len(live):
                break
        hi = np.maximum(lo, hi)
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of suffixes, walking backwards to a kept one."""
        out = np.zeros(len(rows), dtype=np.int64)
        live, at, steps = np.arange(len(rows)), rows.copy(), 0
        while len(live):
            kept = self.kept[at]
            out[live[kept]] = self.positions[self.kept_before[at[kept]]] + steps
            live, at = live[~kept], at[~kept]
            symbol = self.wavelet.access(at)
            at = self.first[symbol] + self.wavelet.rank(symbol, at)
            steps += 1
        return out


# ---- phrases -----------------------------------------------------------------

@dataclass
class Phrases:
    """Windows of the items as word numbers, by length, and whose they are."""
    vocabulary: dict[str, int]
    by_length: list[tuple[np.ndarray, list[list[str]]]]

    @property
    def shortest(self) -> int:
        return min((p.shape[1] for p, _ in self.by_length), default=0)

    @property
    def longest(self) -> int:
        return max((p.shape[1] for p, _ in self.by_length), default=0)


def make_phrases(items: Sequence[tuple[int | None, str]], window: int = WINDOW) -> Phrases:
    vocabulary: dict[str, int] = {}
    found: dict[int, dict[tuple[int, ...], set[str]]] = {}
    for item, text in items:
        ids = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_of(text)]
        n = min(window, len(ids))
        for i in range(len(ids) - n + 1 if n else 0):
            owners = found.setdefault(n, {}).setdefault(tuple(ids[i:i + n]), set())
            if item is not None:
                owners.add(str(item))
    return Phrases(vocabulary, [(np.array(list(w), dtype=np.int32), [sorted(x) for x in w.values()])
                                for _, w in sorted(found.items())])


# ---- scanning ----------------------------------------------------------------

def _stretches(ids: np.ndarray, shortest: int) -> list[tuple[int, int]]:
    """Runs of item words that are long enough to hold a window."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], (ids > 0).view(np.int8), [0]])))
    return [(a, b) for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()) if b - a >= shortest]


def scan(docs: Iterable[list[str]], count: int, phrases: Phrases,
         shard_words: int = SHARD_WORDS) -> list[tuple[list[tuple[int, int]], set[str], int]]:
    """For each of ``count`` documents (lists of words, taken one at a time):
    word spans covered by windows, not merged, the ids of the items whose
    windows occur, and the number of words."""
    spans: list[list[tuple[int, int]]] = [[] for _ in range(count)]
    items: list[set[str]] = [set() for _ in range(count)]
    totals: list[int] = []
    number = phrases.vocabulary.get
    parts: list[np.ndarray] = []   # stretches of the shard being filled, a 0 after each
    places: list[tuple[int, int]] = []  # (document, word) where each begins
    held = 0

    def flush() -> None:
        nonlocal held
        if parts:
            _search(np.concatenate(parts), [len(p) for p in parts], places, phrases, spans, items)
        parts.clear()
        places.clear()
        held = 0

    overlap = phrases.longest - 1
    slice_words = max(shard_words, 4 * phrases.longest)
    for d, words in enumerate(docs):
        totals.append(len(words))
        if not phrases.by_length:
            continue
        ids = np.fromiter((number(w, 0) for w in words), dtype=np.int32, count=len(words))
        for a, b in _stretches(ids, phrases.shortest):
            while a < b:
                part = ids[a:min(b, a + slice_words)]
                if held + len(part) > slice_words:
                    flush()
                parts.append(np.append(part, np.int32(0)))
                places.append((d, a))
                held += len(part) + 1
                a = b if a + slice_words >= b else a + slice_words - overlap
    flush()
    return list(zip(spans, items, totals))


def _search(s: np.ndarray, lengths: list[int], places: list[tuple[int, int]], phrases: Phrases,
            spans: list, items: list) -> None:
    index = FMIndex(s, len(phrases.vocabulary) + 1)
    begins = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    for windows, owners in phrases.by_length:
        lo, hi = index.search(windows)
        hit = np.flatnonzero(hi > lo)
        if not len(hit):
            continue
        counts = (hi - lo)[hit]
        rows = np.repeat(lo[hit] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
        at = index.locate(rows + np.arange(counts.sum()))
        stretch = np.searchsorted(begins, at, side="right") - 1
        n = windows.shape[1]
        for w, k, p in zip(np.repeat(hit, counts).tolist(), stretch.tolist(), at.tolist()):
            d, word = places[k]
            first = word + p - int(begins[k])
            spans[d].append((first, first + n))
            items[d].update(owners[w])


_HITS = "_id long, _key string, _spans array<int>, _items array<string>"
_DIGEST = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()),
                     ("n_items", pa.int64()), ("items_sha256", pa.string()),
                     ("contaminated", pa.bool_()), ("spans", pa.string())])


class Items:
    """The test items in blocks of about ``phrase_bytes`` of text, of which one at a
    time passes through the driver and is broadcast. Long items are cut into slices
    that overlap by a window less one word, so a block's size doesn't depend on them."""

    def __init__(self, benchmark: DataFrame, window: int = WINDOW, phrase_bytes: int = PHRASE_BYTES):
        self.window = window
        items = id_text(benchmark, "item_id")
        total = items.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
        self.blocks = max(1, -(-int(total) // phrase_bytes))
        self.slices = items.mapInArrow(_sliced(window), "_id long, _text string")

    def block(self, k: int) -> Broadcast:
        rows = self.slices.filter(F.pmod(F.xxhash64("_id", "_text"), F.lit(self.blocks)) == k).collect()
        return self.slices.sparkSession.sparkContext.broadcast(
            make_phrases([(r["_id"], r["_text"]) for r in rows], self.window))


def slices_of(text: str, window: int, size: int = SLICE_WORDS) -> Iterator[str]:
    """Texts of at most ``size`` words that together have the item's windows."""
    words = words_of(text)
    size = max(size, 2 * window)
    for at in range(0, max(len(words) - window, 0) + 1, size - window + 1):
        if words:
            yield " ".join(words[at:at + size])


def _sliced(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(i, part) for i, text in zip(*(c.to_pylist() for c in b.columns))
                    for part in slices_of(text, window)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())],
                names=["_id", "_text"])
    return run


def _digest(doc: int | None, text: str, n: int, flat: list[int], items: list[str]) -> tuple:
    spans = covered(flat)
    places = [m.span() for m in _WORD.finditer(lower_ascii(text))] if spans else []
    return (doc, n, sum(e - s for s, e in spans), len(items), sha256_hex(",".join(items)),
            bool(spans), ",".join(f"{places[s][0]}:{places[e - 1][1]}" for s, e in spans))


def _digested(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * len(_DIGEST)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, _DIGEST)], schema=_DIGEST)


def _one_block(phrases: Broadcast):
    """The digest, where one block holds all items."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, texts = (c.to_pylist() for c in b.columns)
            found = scan(map(words_of, texts), len(texts), phrases.value)
            yield _digested([_digest(i, t, n, [x for pair in spans for x in pair], sorted(items))
                             for i, t, (spans, items, n) in zip(ids, texts, found)])
    return run


def _hits_of(phrases: Broadcast):
    """Spans and items of the documents that hold a window of one block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, keys, texts = (c.to_pylist() for c in b.columns)
            found = scan(map(words_of, texts), len(texts), phrases.value)
            rows = [(i, k, [x for e in covered([x for pair in spans for x in pair]) for x in e], sorted(items))
                    for i, k, (spans, items, _) in zip(ids, keys, found) if spans]
            columns = list(zip(*rows)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string()),
                 pa.array(columns[2], pa.list_(pa.int32())), pa.array(columns[3], pa.list_(pa.string()))],
                names=["_id", "_key", "_spans", "_items"])
    return run


def _from_hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids, texts, spans, items = (c.to_pylist() for c in b.columns)
        yield _digested([_digest(i, t, len(words_of(t)), s or [], sorted(set(names or [])))
                         for i, t, s, names in zip(ids, texts, spans, items)])


def _found_in_blocks(texts: DataFrame, items: Items) -> DataFrame:
    """_id, _key, _spans, _items of the documents (``_id``, ``_key``, ``_text``) with hits,
    once for rows that repeat. Each block is broadcast, scanned for, written and given up
    before the next one is built."""
    found = None
    for k in range(items.blocks):
        phrases = items.block(k)
        hits = texts.select("_id", "_key", "_text").mapInArrow(released(_hits_of(phrases)), _HITS)
        hits = written(hits.groupBy("_id", "_key").agg(  # equal texts have equal hits
            F.first("_spans").alias("_spans"), F.first("_items").alias("_items")), "hits")
        phrases.destroy()
        found = hits if found is None else found.unionByName(hits)
    return found.groupBy("_id", "_key").agg(
        F.flatten(F.collect_list("_spans")).alias("_spans"),   # an entry for each block at most
        F.array_distinct(F.flatten(F.collect_list("_items"))).alias("_items"))


def _with_hits(texts: DataFrame, found: DataFrame) -> DataFrame:
    near = found.select(F.col("_id").alias("_i"), F.col("_key").alias("_m"), "_spans", "_items")
    return texts.join(near, texts["_id"].eqNullSafe(near["_i"]) & (texts["_key"] == near["_m"]),
                      "left").drop("_i", "_m")


def covered(flat: Sequence[int]) -> list[tuple[int, int]]:
    """Merged word spans of a flat list of starts and ends."""
    out: list[list[int]] = []
    for s, e in sorted(zip(flat[::2], flat[1::2])):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  phrase_bytes: int = PHRASE_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans
    (covered code points of the text) for every document. With more than one
    block of items the documents are scanned once for each, and what was found is
    joined with them at the end."""
    items = Items(benchmark, window, phrase_bytes)
    schema = ("doc_id long, n_words long, n_hit long, n_items long, "
              "items_sha256 string, contaminated boolean, spans string")
    texts = id_text(docs)
    if items.blocks == 1:
        return texts.mapInArrow(_one_block(items.block(0)), schema)
    texts = texts.withColumn("_key", F.sha2("_text", 256))
    return _with_hits(texts, _found_in_blocks(texts, items)).select(
        "_id", "_text", "_spans", "_items").mapInArrow(released(_from_hits), schema)


def _cut(text: str, flat: Sequence[int]) -> str:
    """The text without the words of the spans."""
    places = [m.span() for m in _WORD.finditer(lower_ascii(text))]
    return cut_spans(text, [(places[s][0], places[e - 1][1]) for s, e in covered(flat)])


def remove_windows(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                   phrase_bytes: int = PHRASE_BYTES, text_col: str = "text") -> DataFrame:
    """The documents with the covered passages cut out of their texts; rows
    and other columns stay. Changed texts are searched again until nothing is
    found, since what stood on both sides of a cut may form a new window."""
    items = Items(benchmark, window, phrase_bytes)
    if items.blocks > 1:
        return _remove_in_rounds(docs, items, text_col)
    phrases = items.block(0)
    at = docs.columns.index(text_col)

    def clean(texts: list[str | None]) -> list[str | None]:
        todo = [i for i, t in enumerate(texts) if t]
        while todo:
            found = scan((words_of(texts[i]) for i in todo), len(todo), phrases.value)
            hit = [(i, [x for pair in spans for x in pair]) for i, (spans, _, _) in zip(todo, found) if spans]
            for i, flat in hit:
                texts[i] = _cut(texts[i], flat)
            todo = [i for i, _ in hit]
        return texts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            columns = list(b.columns)
            columns[at] = pa.array(clean(b.column(at).to_pylist()), pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=b.schema.names)

    return docs.mapInArrow(released(run), docs.schema)


def _cut_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids, keys, texts, spans = (c.to_pylist() for c in b.columns)
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(list(map(_cut, texts, spans)), pa.string())],
            names=["_id", "_key", "_new"])


def _remove_in_rounds(docs: DataFrame, items: Items, text_col: str) -> DataFrame:
    """The same with several blocks: the texts that still have hits are cut and searched
    again. They are named by the SHA-256 of what stood there first; each round holds
    changed texts only, once for rows that repeat."""
    ship_package(docs.sparkSession)
    no_id = F.lit(None).cast("long").alias("_id")
    todo = docs.select(no_id, F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text")).select(
        "_id", F.sha2("_text", 256).alias("_key"), "_text")
    changed = None
    while True:
        hits = _found_in_blocks(todo, items).filter(F.size("_spans") > 0)
        cut = written(_with_hits(todo, hits).filter(F.col("_spans").isNotNull())
                      .select("_id", "_key", "_text", "_spans")
                      .mapInArrow(released(_cut_rows), "_id long, _key string, _new string")
                      .groupBy("_key").agg(F.first("_new").alias("_new")), "cut")
        if cut.isEmpty():
            break
        todo = cut.select(no_id, "_key", F.col("_new").alias("_text"))
        # the latest text of each first text
        changed = cut if changed is None else written(
            changed.join(cut.withColumnRenamed("_new", "_newer"), "_key", "left")
            .select("_key", F.coalesce("_newer", "_new").alias("_new")), "changed")
    if changed is None:
        return docs
    key = F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256)
    names = docs.columns
    near = changed.select(F.col("_key").alias("_changed_key"), F.col("_new").alias("_changed_text"))
    return docs.join(near, key == near["_changed_key"], "left").select(
        *[F.coalesce("_changed_text", docs[c]).alias(c) if c == text_col else docs[c] for c in names])
