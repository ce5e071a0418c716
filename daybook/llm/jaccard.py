"""N-gram Jaccard join: universe partition and pigeonhole, verified exactly.

A document's set holds its distinct 5-word shingles (hashed to 64 bits).
Two sets of Jaccard similarity 0.8 or more, the smaller one of size r, differ
in at most d = r // 4 shingles. Sizes are grouped in bands [2^k, 2^(k+1)); for
each band the universe of hashes is cut into m segments. Of the smaller set's
non-empty segments, at most d can differ from the other set's, so among any
d + 1 of them one is equal in both. What is shuffled:

* index rows: a hash of the content of every non-empty segment, for the band
  of the set and for the next lower one if a partner can be there;
* one-deletion rows, in bands of small sets: the content of every segment less
  one shingle. A set with fewer than d + 1 non-empty segments there gives its
  largest segments the threshold 1 (worth two): it looks up its content, its
  content less each shingle, and its content among the others' one-deletion
  rows;
* sets for which even that is not enough look up every set of the band (rows
  dealt over many buckets); with the number of segments chosen this is so
  rare that only the guarantee counts.

Cost-based allocation: a set needs no more than d + 1 of its segments. Those
whose contents are most frequent among all sets are given up first, so
passages that many documents share make few candidates.

Components come first. Equal sets are one class from the start. Candidates
are verified on the exact sets: first the members of a row group against two
of them, which joins groups of near copies. The classes in groups that still
hold several components are few; among them the universe is cut into single
shingles, each set indexes and looks up only its rarest ones, and all pairs
between components that this brings together are verified.

Links come from the components, as similar sets are always in one: two classes
of a component of two are linked; in a larger one all pairs of classes are
compared exactly, in pairs of blocks of an expected ``LINK_BLOCK`` classes by
matrix products, so a component of any size is dealt over many tasks and no
row is made for a pair. A document's links are the other rows whose set has
similarity 0.8 or more with its own, equal ones included.

Defined results: NULL, empty or blank texts have no shingles, n_shingles 0, no
links and their own id as component; a text of one to four words is one shingle; a
NULL id takes part, but is nobody's component id; repeated rows share a
component; an empty table gives no rows; texts are read whole. Other columns
may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import id_text, release_shuffles, released, rows_by_id, stored, written

WORDS = 5
#: Bands below this one (sets of fewer than 64 shingles) use one-deletion rows.
DELETION_BANDS = 6
#: Segments per needed segment in the other bands.
SPARE = 1.2
#: Buckets for sets that look up a whole band.
BAND_BUCKETS = 1024
CACHE_WORDS = 300_000
CHUNK_ROWS = 200_000
#: Expected classes in a block of a component, and shingles in one matrix product.
LINK_BLOCK, LINK_SHINGLES = 256, 4096
#: 64-bit words of a set's sketch.
SKETCH_WORDS = 8

INDEX, PROBE, FORCED = 1, 2, 4

_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xBF58476D1CE4E5B9)
_C = np.uint64(0x94D049BB133111EB)
_FACTORS = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB,
                     0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)
_FULL, _LESS, _BAND = (np.uint64(x) for x in (1, 2, 3))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit over the others."""
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """Hash of a word (bytes), remembered for the first ``CACHE_WORDS`` words."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) < CACHE_WORDS:
            self[word] = h
        return h


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values; np.unique hashes 64-bit integers, which is slower here."""
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


def shingle_set(text: str, hashes: dict, k: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the text's k-word shingles."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # ASCII case, ASCII white space
    if not words:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    n = min(k, len(h))
    s = np.full(len(h) - n + 1, n, dtype=np.uint64)
    for i in range(n):
        s += h[i:len(h) - n + 1 + i] * _FACTORS[i]
    return distinct(mix(s))


def set_key(s: np.ndarray) -> tuple[int, int]:
    """Two integers of 60 and 63 bits that name the set."""
    d = xxhash.xxh3_128_intdigest(s.tobytes())
    return d & ((1 << 60) - 1), (d >> 65) & ((1 << 63) - 1)


def sketch(s: np.ndarray) -> np.ndarray:
    """Bit i tells whether an odd number of the shingles fall on i. Two sketches
    differ in no more bits than the sets do in shingles."""
    held = np.bincount((s & np.uint64(64 * SKETCH_WORDS - 1)).astype(np.int64),
                       minlength=64 * SKETCH_WORDS)
    return np.packbits((held & 1).astype(np.uint8)).view(np.int64)


def segments(band: int) -> int:
    """How many segments the universe is cut into for the sets of a band."""
    needed = ((2 << band) - 1) // 4 + 1
    return needed if band < DELETION_BANDS else int(np.ceil(needed * SPARE))


class Cut:
    """The segments of one set in the scheme of one band."""

    def __init__(self, s: np.ndarray, band: int):
        m = np.uint64(segments(band))
        number = ((s >> np.uint64(32)) * m) >> np.uint64(32)
        self.begin = np.concatenate([[0], np.flatnonzero(number[1:] != number[:-1]) + 1])
        self.size = np.diff(np.concatenate([self.begin, [len(s)]]))
        self.value = mix(s ^ _A)
        self.content = np.add.reduceat(self.value, self.begin)
        self.place = number[self.begin] * _A + np.uint64(band + 1) * _C

    def full(self) -> np.ndarray:
        return mix(self.content + self.place + _FULL * _B)

    def less(self, of: np.ndarray, kind: np.uint64) -> np.ndarray:
        """Contents of the segments ``of``, less each of their shingles."""
        size = self.size[of]
        segment = np.repeat(of, size)
        token = np.arange(size.sum()) + np.repeat(
            self.begin[of] - np.concatenate([[0], np.cumsum(size)[:-1]]), size)
        return mix(self.content[segment] - self.value[token] + self.place[segment] + kind * _B)


def band_rows(band: int, buckets: np.ndarray) -> np.ndarray:
    return mix(buckets.astype(np.uint64) * _A + np.uint64(band + 1) * _C + _BAND * _B)


def slack(s: np.ndarray) -> int:
    """Non-empty segments that a set can do without as the smaller one."""
    if not len(s):
        return 0
    return len(Cut(s, len(s).bit_length() - 1).begin) - (len(s) // 4 + 1)


def signatures(s: np.ndarray, key: int) -> Iterator[tuple[np.ndarray, int]]:
    """(hashes, role) of all rows of a set."""
    n = len(s)
    band = n.bit_length() - 1
    bucket = np.array([key % BAND_BUCKETS])
    for b in range(band, -1, -1):
        if 5 * ((2 << b) - 1) < 4 * n:
            break
        cut = Cut(s, b)
        yield cut.full(), INDEX | PROBE if b == band else INDEX
        yield band_rows(b, bucket), INDEX
        multiple = np.flatnonzero(cut.size >= 2)
        if b < DELETION_BANDS and len(multiple):
            yield cut.less(multiple, _LESS), INDEX
        if b < band:
            continue
        missing = n // 4 + 1 - len(cut.begin)
        if missing > 0 and b < DELETION_BANDS and len(multiple):
            of = multiple[np.argsort(-cut.size[multiple], kind="stable")][:missing]
            yield cut.less(of, _FULL), FORCED
            yield mix(cut.content[of] + cut.place[of] + _LESS * _B), FORCED
            missing -= len(of)
        if missing > 0:
            yield band_rows(b, np.arange(BAND_BUCKETS)), FORCED


# ---- passes over the texts -----------------------------------------------------

def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for b in batches:
        rows = []
        for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            s = shingle_set(text, hashes)
            rows.append((doc, *set_key(s), len(s), slack(s)))
        columns = list(zip(*rows)) or [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                         names=["doc_id", "k1", "k2", "n", "slack"])


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes, done = WordHashes(), set()
    sig: list[np.ndarray] = []
    ref: list[np.ndarray] = []
    held = 0

    def out() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(sig).view(np.int64)), pa.array(np.concatenate(ref))],
            names=["sig", "ref"])
        sig.clear()
        ref.clear()
        return batch

    for b in batches:
        for text in b.column(1).to_pylist():
            s = shingle_set(text, hashes)
            key = set_key(s)
            if not len(s) or key in done:  # copies within a task give rows once
                continue
            done.add(key)
            for h, role in signatures(s, key[0]):
                sig.append(h)
                ref.append(np.full(len(h), key[0] << 3 | role, dtype=np.int64))
                held += len(h)
            if held >= CHUNK_ROWS:
                yield out()
                held = 0
    if sig:
        yield out()


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(k1, k2, text) to (k1, k2, set, sketch), where the text is of that class."""
    hashes = WordHashes()
    for b in batches:
        rows = []
        for k1, k2, text in zip(*(c.to_pylist() for c in b.columns)):
            s = shingle_set(text, hashes)
            if set_key(s) == (k1, k2):
                rows.append((k1, k2, s.view(np.int64), sketch(s)))
        columns = list(zip(*rows)) or [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
             *(pa.array(c, pa.list_(pa.int64())) for c in columns[2:])],
            names=["k1", "k2", "items", "sketch"])


def similar(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Which sets of ``a`` (rows) are similar to which of ``b`` (columns)."""
    sizes = np.array([len(x) for x in [*a, *b]], dtype=np.int64)
    items, place, held = np.unique(np.concatenate([*a, *b]), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    shared = held > 1
    number = np.cumsum(shared) - 1
    use = shared[place]
    place, owner = number[place[use]], owner[use]
    order = np.argsort(place, kind="stable")
    place, owner = place[order], owner[order]
    common = np.zeros((len(a), len(b)), dtype=np.int64)
    for low in range(0, int(shared.sum()), LINK_SHINGLES):
        i, j = np.searchsorted(place, (low, low + LINK_SHINGLES))
        width = min(LINK_SHINGLES, int(shared.sum()) - low)
        has = np.zeros((len(sizes), width), dtype=np.float32)
        has[owner[i:j], place[i:j] - low] = 1
        common += (has[:len(a)] @ has[len(a):].T).astype(np.int64)  # exact: at most 4096
    union = sizes[:len(a), None] + sizes[None, len(a):] - common
    return 100 * common >= 80 * union


def _block_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by component and pair of blocks, to (k1, k2, links): for each
    class the rows of those linked to it in this pair of blocks."""
    def out(key: tuple, rows: list[tuple]) -> pa.RecordBatch:
        first, second = key[2], key[3]
        sides = [[r for r in rows if r[0] == block] for block in (first, second)]
        a, b = sides
        names, links = [], []
        if a and b:
            near = similar([r[4] for r in a], [r[4] for r in b])
            if first == second:
                np.fill_diagonal(near, False)
            names, links = a, near @ np.array([r[3] for r in b], dtype=np.int64)
            if first != second:
                names = a + b
                links = np.concatenate([links, near.T @ np.array([r[3] for r in a], dtype=np.int64)])
        return pa.RecordBatch.from_arrays(
            [pa.array([r[1] for r in names], pa.int64()), pa.array([r[2] for r in names], pa.int64()),
             pa.array(links, pa.int64())], names=["k1", "k2", "links"])

    key, rows = None, []
    for batch in batches:
        items = batch.column(8)
        flat, at = items.values.to_numpy(zero_copy_only=False), items.offsets.to_numpy()
        for i, r in enumerate(zip(*(c.to_pylist() for c in batch.columns[:8]))):
            if r[:4] != key:
                if len(rows) > 1:
                    yield out(key, rows)
                key, rows = r[:4], []
            rows.append((*r[4:], flat[at[i]:at[i + 1]].copy()))
    if len(rows) > 1:
        yield out(key, rows)


# ---- components ------------------------------------------------------------------

def components(edges: DataFrame) -> DataFrame:
    """(v, label): the least vertex of each vertex's component, for the
    vertices of ``edges`` (a, b). Every round each vertex takes the least label
    among its own and its neighbours', then the label of that label; rounds
    end when no label changes."""
    both = written(edges.select("a", "b").unionByName(
        edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = written(both.groupBy("a").agg(F.min("b").alias("least")).select(
        F.col("a").alias("v"), F.least("a", "least").alias("label")), "labels")
    while True:
        near = (both.join(labels, both["b"] == labels["v"])
                .groupBy("a").agg(F.min("label").alias("near")))
        new = labels.join(near, labels["v"] == near["a"]).select(
            "v", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        hop = labels.select(F.col("v").alias("_v"), F.col("label").alias("_hop"))
        new = written(new.join(hop, new["label"] == hop["_v"], "left").select(
            "v", "was", F.least("label", F.coalesce("_hop", "label")).alias("label")), "labels")
        changed = new.filter(F.col("label") != F.col("was")).limit(1).count()
        labels = new.select("v", "label")
        if not changed:
            return labels


# ---- the join ------------------------------------------------------------------

def _class(k1: str = "k1", k2: str = "k2"):
    return F.struct(F.col(k1).alias("k1"), F.col(k2).alias("k2"))


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes whose sets are similar."""
    left = sets.select(F.col("v").alias("a"), F.col("items").alias("_left"))
    right = sets.select(F.col("v").alias("b"), F.col("items").alias("_right"))
    common = F.size(F.array_intersect("_left", "_right"))
    union = F.size("_left") + F.size("_right") - common
    return (pairs.join(left, "a").join(right, "b")
            .filter(100 * common >= 80 * union).select("a", "b"))


def _near_sizes(x: str, y: str):
    return 5 * F.least(x, y) >= 4 * F.greatest(x, y)


def _near_sketches(x: str, y: str, n: str, m: str) -> Column:
    """Sets of n and m shingles are similar if they differ in (n + m) / 9 at most."""
    bits = sum((F.bit_count(F.col(x)[i].bitwiseXOR(F.col(y)[i])) for i in range(SKETCH_WORDS)), F.lit(0))
    return 9 * bits <= F.col(n) + F.col(m)


def shared_rows(docs: DataFrame) -> DataFrame:
    """sig, k1, role, many: the rows whose content at least two sets hold (how
    many do) and some set may look up."""
    by = Window.partitionBy("sig")
    before = F.lag("ref").over(by.orderBy("ref"))
    role = F.col("ref").bitwiseAND(7)
    return (docs.mapInArrow(released(_signatures), "sig long, ref long")
            .withColumn("_before", before)  # copies in other tasks repeat rows
            .filter(F.col("_before").isNull() | (F.col("_before") != F.col("ref")))
            .select("sig", F.shiftright("ref", 3).alias("k1"), role.alias("role"),
                    F.count(F.lit(1)).over(by).alias("many"), F.max(role).over(by).alias("_asked"))
            .filter((F.col("many") > 1) & (F.col("_asked") >= PROBE)).drop("_asked"))


def linked_classes(docs: DataFrame, described: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(v, label) of the classes of equal sets that have a link to another, and
    the sets (v, items, sketch) of these and others."""
    spark = docs.sparkSession
    shared = stored(shared_rows(docs))
    release_shuffles(spark)

    # allocation: of a set's own contents the most frequent are given up, as
    # many as it can do without; the others and the forced ones are looked up
    classes = described.filter("n > 0").groupBy("k1", "k2").agg(
        F.min("n").alias("n"), F.min("slack").alias("slack"), F.min("doc_id").alias("doc"))
    optional = F.col("role").bitwiseAND(PROBE) != 0
    rank = F.row_number().over(Window.partitionBy("k1", "k2", optional)
                               .orderBy(F.desc("many"), "sig"))
    probe = ((optional & (rank > F.greatest("slack", F.lit(0))))
             | (F.col("role").bitwiseAND(FORCED) != 0))
    rows = (shared.join(classes, "k1")
            .select("sig", _class().alias("v"), "n", "doc", "role", probe.alias("probe"))
            .groupBy("sig", "v").agg(F.min("n").alias("n"), F.min("doc").alias("doc"),
                                     F.max("probe").alias("probe"),
                                     F.max(F.col("role").bitwiseAND(INDEX) != 0).alias("index")))
    by = Window.partitionBy("sig")
    rows = stored(rows.withColumn("_asked", F.max("probe").over(by))
                  .withColumn("_lo", F.min("v").over(by)).withColumn("_hi", F.max("v").over(by))
                  .filter(F.col("_asked") & (F.col("_lo") != F.col("_hi")))
                  .drop("_asked", "_lo", "_hi"))
    del shared
    release_shuffles(spark)

    heads = (rows.groupBy("v").agg(F.min("doc").alias("_want"))
             .groupBy("_want").agg(F.collect_set("v").alias("_vs")))  # one class for each text
    texts = rows_by_id(docs, heads).select(F.explode("_vs").alias("v"), "_text")
    sets = stored(texts.select("v.k1", "v.k2", "_text")
                  .mapInArrow(released(_sets), "k1 long, k2 long, items array<long>, sketch array<long>")
                  .groupBy("k1", "k2").agg(F.first("items").alias("items"),
                                           F.first("sketch").alias("sketch"))
                  .select(_class().alias("v"), "items", "sketch"))
    release_shuffles(spark)

    # stars: the members of a row group against two of them
    edges = stored(_verified(_stars(rows).distinct(), sets))
    label = components(edges)
    mixed = stored(_mixed(rows.drop("doc"), label))
    release_shuffles(spark)

    # what is left: the same with the universe cut into single shingles
    last = stored(_verified(_single_shingles(mixed, sets), sets))
    return (label if last.isEmpty() else components(edges.unionByName(last))), sets


def class_links(label: DataFrame, sets: DataFrame, copies: DataFrame) -> DataFrame:
    """k1, k2, links: for the classes of ``label`` the rows of all classes
    linked to them, where ``copies`` (v, copies) has the rows of a class."""
    members = label.join(copies, "v")
    whole = members.groupBy("label").agg(F.count(F.lit(1)).alias("_classes"), F.sum("copies").alias("_rows"))
    members = stored(members.join(whole, "label"))
    pairs = members.filter("_classes = 2").select(
        "v.k1", "v.k2", (F.col("_rows") - F.col("copies")).alias("links"))
    blocks = F.ceil(F.col("_classes") / LINK_BLOCK)
    block = F.pmod(F.xxhash64("v"), F.col("_blocks"))
    keys = ["l1", "l2", "first", "second"]
    dealt = (members.filter("_classes > 2").withColumn("_blocks", blocks).withColumn("block", block)
             .join(sets.select("v", "items"), "v")
             .withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)))
             .select(F.col("label.k1").alias("l1"), F.col("label.k2").alias("l2"),
                     F.least("block", "_other").alias("first"), F.greatest("block", "_other").alias("second"),
                     "block", "v.k1", "v.k2", "copies", "items"))
    found = dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(
        _block_links, "k1 long, k2 long, links long")
    return pairs.unionByName(found).groupBy("k1", "k2").agg(F.sum("links").alias("links"))


def _stars(rows: DataFrame) -> DataFrame:
    """Pairs (a < b) of the heads of each row group, members that look it up,
    and the members that they can be similar to. The heads are the smallest
    member and one in a random order that is the same for all groups."""
    def head(order: Column) -> Column:
        return F.min(F.when(F.col("probe"), F.struct(order.cast("long").alias("o"), "n", "v"))).over(
            Window.partitionBy("sig"))

    return (rows.withColumn("_heads", F.array(head(F.col("n")), head(F.xxhash64("v"))))
            .withColumn("p", F.explode("_heads"))
            .filter((F.col("p.v") != F.col("v")) & _near_sizes("n", "p.n")
                    & (F.col("probe") | (F.col("p.n") <= F.col("n"))))
            .select(F.least("p.v", "v").alias("a"), F.greatest("p.v", "v").alias("b")))


def _mixed(rows: DataFrame, label: DataFrame, group: str = "sig") -> DataFrame:
    """The rows, with their component, of groups that hold several components."""
    by = Window.partitionBy(group)
    return (rows.join(label, "v", "left").withColumn("label", F.coalesce("label", "v"))
            .withColumn("_lo", F.min("label").over(by)).withColumn("_hi", F.max("label").over(by))
            .filter(F.col("_lo") != F.col("_hi")).drop("_lo", "_hi"))


def _single_shingles(mixed: DataFrame, sets: DataFrame) -> DataFrame:
    """Candidate pairs between components among the classes of ``mixed``: every
    shingle is a segment, and a set indexes and looks up the first n // 5 + 1
    of its n shingles. The order is the same for all sets: shingles within one
    component first, then those that fewest of these classes hold. Similar
    sets share at least 4/5 of either one's shingles, so the first shared one
    is among those of both; between components it is none of the former. Pairs
    whose sketches differ too much cannot be similar and are not made."""
    classes = mixed.groupBy("v").agg(F.min("n").alias("n"), F.min("label").alias("label"))
    by = Window.partitionBy("sig")
    rows = (classes.join(sets, "v").select("v", "n", "label", F.explode("items").alias("sig"))
            .withColumn("many", F.count(F.lit(1)).over(by))
            .withColumn("_lo", F.min("label").over(by)).withColumn("_hi", F.max("label").over(by))
            .filter(F.col("_lo") != F.col("_hi")).drop("_lo", "_hi"))
    rank = F.row_number().over(Window.partitionBy("v").orderBy(F.desc("many"), "sig"))
    rows = stored(rows.withColumn("_rank", rank)
                  .filter(F.col("_rank") > F.col("n") - F.floor(F.col("n") / 5) - 1)
                  .join(sets.select("v", "sketch"), "v")
                  .select("sig", "v", "n", "label", "sketch"))
    release_shuffles(rows.sparkSession)
    other = rows.select("sig", F.col("label").alias("to"), F.col("v").alias("w"),
                        F.col("n").alias("m"), F.col("sketch").alias("other"))
    return (rows.join(other, "sig")
            .filter((F.col("label") != F.col("to")) & (F.col("v") < F.col("w")) & _near_sizes("n", "m")
                    & _near_sketches("sketch", "other", "n", "m"))
            .select(F.col("v").alias("a"), F.col("w").alias("b")).distinct())


def _components(docs: DataFrame, links: bool) -> DataFrame:
    """doc_id, n_shingles, component_id and, if wanted, n_links for every document."""
    docs = id_text(docs)
    described = stored(docs.mapInArrow(
        released(_describe), "doc_id long, k1 long, k2 long, n long, slack long"))
    label, sets = linked_classes(docs, described)
    least = described.filter("n > 0").groupBy("k1", "k2").agg(
        F.min("doc_id").alias("_doc"), F.count(F.lit(1)).alias("copies"))
    named = (least.withColumn("v", _class()).join(label, "v", "left")
             .withColumn("label", F.coalesce("label", "v")))
    heads = named.groupBy("label").agg(F.min("_doc").alias("component_id"))
    classes = named.join(heads, "label").select("k1", "k2", "component_id", "copies")
    counted = []
    if links:
        near = class_links(label, sets, least.select(_class().alias("v"), "copies"))
        classes = classes.join(near, ["k1", "k2"], "left")
        counted = [F.when(F.col("n") == 0, F.lit(0)).otherwise(
            F.col("copies") - 1 + F.coalesce("links", F.lit(0))).cast("long").alias("n_links")]
    return (described.join(classes, ["k1", "k2"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") == 0, F.col("doc_id"))
                    .otherwise(F.col("component_id")).alias("component_id"), *counted))


def jaccard_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links for every document."""
    return _components(docs, links=True)


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """The documents that are the least of their component, with all columns.
    A document whose id is NULL stays if its group has no other id; of rows
    that repeat an id and a text one stays."""
    columns = docs.columns
    keep = _components(docs, links=False).filter(
        F.col("doc_id").eqNullSafe(F.col("component_id"))).select(
        F.col("doc_id").alias("_keep")).distinct()
    kept = docs.join(keep, docs["doc_id"].cast("long").eqNullSafe(keep["_keep"]))
    # doc_id names a row as a rule; where rows repeat it, one row of each text stays
    first = F.row_number().over(Window.partitionBy("doc_id", F.xxhash64("text"))
                                .orderBy(F.lit(0)))
    return kept.withColumn("_nth", first).filter("_nth = 1").select(*columns)
