"""Packing: first-fit decreasing with a tournament tree of bin capacities,
run independently in randomised groups of documents.

Every document becomes token ids (its text by a byte-level BPE file, then
one end id). Ids are cut at multiples of the sequence length: the full
pieces fill a sequence each, the rest of each document is a piece to be
packed. Pieces are dealt into groups of a bounded expected size by a hash (their
number follows the texts' bytes, so a few long documents make many groups);
in each group the pieces, longest first, go into the first bin (sequence)
with room for them, found in a tree that holds the largest free space of the
bins below each node.

Defined results: NULL text is empty, an empty document is its end id alone;
repeated rows are packed row by row (copies of one piece are dealt by their
number, so one text may be any share of the table); ties between pieces of
one length go by id, start and checksum; a document of any length is cut; an
empty table gives no rows. Other columns may have any names.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import id_text, released

SEQUENCE = 1024
END_ID = 0
#: Pieces that a group holds on average, if an id stands for so many bytes. (It stands
#: for one at least, so a group's expected pieces are bounded by three times as many.)
GROUP_PIECES, ID_BYTES = 4096, 3
TOKENIZER = "byte_bpe_50k.json"

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, _group long")
PACKED = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")

# Characters beyond Latin letters, and rarer white space, of which engines
# may have different ideas.
_OTHER = re.compile("[^\\t\\n\\r\\x20-\\x7e\\xa1-\u024f]|<\\|")

# Fixed value: the pre-tokeniser's pattern of this kind of vocabulary file.
PATTERN = (r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
#: Characters of text that a worker has both engines encode.
PROBE_CHARS = 50_000


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def _byte_ranks(path: str) -> dict[bytes, int]:
    """The ids of the vocabulary's byte strings. In the file, printable bytes
    stand for themselves and the others, in order, for code points from 256."""
    with open(path, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = (b for b in range(256) if b not in plain)
    byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
    return {bytes(byte[c] for c in token): i for token, i in vocabulary.items()
            if all(c in byte for c in token)}


class Encoder:
    """Token ids of texts, as the ``tokenizers`` library gives them. Texts of
    Latin letters are encoded by a second engine that reads the same vocabulary
    file and is several times as fast; a worker compares both on its first
    texts. All others are encoded by ``tokenizers`` itself."""

    def __init__(self, path: str):
        from tiktoken import Encoding
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        ranks = {b: i for b, i in _byte_ranks(path).items() if b != b"<|endoftext|>"}
        self.fast = Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.probed = 0

    def encode(self, text: str) -> np.ndarray:
        if not _OTHER.search(text):
            ids = self.fast.encode_ordinary(text)
            if self.probed >= PROBE_CHARS:
                return np.array(ids, dtype="<u4")
            self.probed += len(text)
            if ids != self.tokenizer.encode(text, add_special_tokens=False).ids:
                raise ValueError("the engines disagree on this vocabulary")
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4")


def pieces_of(ids: np.ndarray, length: int = SEQUENCE) -> list[tuple[int, int, int]]:
    """(start, length, crc32) of the pieces of one document."""
    out = []
    for start in range(0, len(ids), length):
        part = np.ascontiguousarray(ids[start:start + length], dtype="<u4")
        out.append((start, len(part), zlib.crc32(part.tobytes())))
    return out


class Tournament:
    """First bin, in the order in which bins were opened, with enough room."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1
        while self.leaves < max(1, bins):
            self.leaves *= 2
        self.free = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> tuple[int, int]:
        """(bin, free space in it before)."""
        free, node = self.free, 1
        while node < self.leaves:
            node *= 2
            if free[node] < size:
                node += 1
        bin_, before = node - self.leaves, free[node]
        free[node] = before - size
        node //= 2
        while node:
            largest = max(free[2 * node], free[2 * node + 1])
            if free[node] == largest:
                break
            free[node] = largest
            node //= 2
        return bin_, before


def first_fit_decreasing(sizes: Sequence[int], capacity: int = SEQUENCE) -> list[tuple[int, int]]:
    """(bin, offset) of every size, given in decreasing order."""
    tree = Tournament(len(sizes), capacity)
    return [(b, capacity - before) for b, before in map(tree.place, sizes)]


def _mix(*values: int) -> int:
    """64 bits from a few integers (deals pieces into groups)."""
    h = 0x9E3779B97F4A7C15
    for v in values:
        h = ((h ^ (v & 0xFFFFFFFFFFFFFFFF)) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
        h ^= h >> 29
    return (h * 0x94D049BB133111EB & 0xFFFFFFFFFFFFFFFF) >> 16


def token_pieces(docs: DataFrame, groups: int, tokenizer: str | None = None,
                 length: int = SEQUENCE) -> DataFrame:
    """One row for each piece of each document, with the group it is dealt to."""
    path = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        copies: Counter = Counter()
        for b in batches:
            out: list[tuple] = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = np.append(encoder.encode(text), np.uint32(END_ID))
                for start, n, crc in pieces_of(ids, length):
                    key = (doc, start, crc)
                    copy = copies[key]
                    copies[key] += 1
                    out.append((doc, start, n, crc, len(ids),
                                _mix(-1 if doc is None else doc, start, crc, copy) % groups))
            columns = list(zip(*out)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                             names=["doc_id", "start", "length", "ids_crc32",
                                                    "doc_tokens", "_group"])

    return id_text(docs).mapInArrow(released(run), PIECES)


def _pack_group(capacity: int):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "start", "ids_crc32"],
                              ascending=[False, True, True, True], kind="stable")
        placed = first_fit_decreasing(pdf["length"].tolist(), capacity)
        pdf["sequence_id"] = [int(key[0]) * (1 << 32) + b for b, _ in placed]
        pdf["offset"] = [o for _, o in placed]
        for c in ("doc_id",):  # a group with NULL ids arrives as floats
            pdf[c] = pdf[c].astype("Int64")
        return pdf.drop(columns="_group")
    return run


def pack(docs: DataFrame, length: int = SEQUENCE, tokenizer: str | None = None,
         group_pieces: int = GROUP_PIECES) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of
    every piece; sequences hold at most ``length`` ids."""
    seen = docs.agg(F.count(F.lit(1)).alias("n"),
                    F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first()
    # a rest for each document and a full piece for every ``length`` ids
    expected = seen["n"] + seen["b"] // (ID_BYTES * length)
    groups = max(1, -(-expected // group_pieces))
    pieces = token_pieces(docs, groups, tokenizer, length)
    return pieces.groupBy("_group").applyInPandas(_pack_group(length), PACKED)
