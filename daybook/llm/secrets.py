"""Secret scans: a worklist of layers, decoded until nothing new appears.

The text is the first layer. Each layer is scanned, then unwrapped: URL
escapes, Unicode escapes, base64 runs, and compressed data (gzip, zlib, bz2,
xz, zstd) inside them. Every content is scanned and unwrapped once in a
document, but knows all places where it stands; a finding goes up to each of
them, unless it is known there (which ends cycles), and so is mapped back,
layer by layer, to code points of the text: through URL and
Unicode escapes to the escapes' exact places, through base64 to the
characters that carry the bytes, through compressed data to the whole run.

Kinds (fixed patterns): ``assign``, ``access``, ``hex``.

Base64 runs are joined over line breaks and decoded at all four alignments, so
a payload may stand behind any prefix of the same letters ("api/v1/").
Decoded bytes are never dropped: what is not UTF-8 is read as Latin-1, and
bytes with NULs as UTF-16, too. A reading in which nothing can be found is not
counted as a layer unless it is printable text.

Defined results: NULL texts are empty and hold nothing; a finding in a layer
that maps to a span already reported for its kind is reported once; repeated
rows are judged row by row; texts are read whole, whatever their length; an
empty table gives no rows. Other columns may have any names. Compressed data
is read to its end, all members of it, in windows of ``LAYER_BYTES``; they end
where nothing that can be found goes on. Only an unbroken run of letters longer
than half a window and twice the packed data (as in a decompression bomb) is
read in overlapping parts; data with such runs is counted in ``n_cut``.
"""

from __future__ import annotations

import binascii
import bz2
import lzma
import re
import zlib
from bisect import bisect_right
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame

from daybook.llm.common import cut_spans, id_text, released, sha256_hex, ship_package

# The kinds, in their order, and their patterns.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # the runs of [0-9a-f]+ that are long enough

#: Unpacked data beyond this is read in windows.
LAYER_BYTES = 32 << 20
#: Bytes unpacked at a time, and the largest window of the zstd format.
PIECE_BYTES, ZSTD_WINDOW = 1 << 20, 1 << 31

_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
_URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(
    r"\\u[dD][89abAB][0-9A-Fa-f]{2}\\u[dD][c-fC-F][0-9A-Fa-f]{2}"
    r"|\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\u\{[0-9A-Fa-f]{1,6}\}|\\x[0-9A-Fa-f]{2}"
    r"|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};")
#: Base64, also wrapped: line breaks, with blanks around them, may stand anywhere.
_BREAK = re.compile(r"[ \t]*+(?:\r\n?|\n)[ \t]*+")
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/_-](?:[ \t]*+(?:\r\n?|\n)[ \t]*+(?=[A-Za-z0-9+/_-]))?+){16,}+={0,2}")
#: Runs of bytes as escapes.
_BYTES = re.compile(r"(?:\\x[0-9A-Fa-f]{2}){4,}")

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each kind in one layer."""
    out: list[Span] = []
    low = text.lower()
    if any(name in low for name in _NAMES):
        out += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    out += [("hex", *m.span()) for m in HEX.finditer(text)]
    return out


def ordered(spans: set[Span] | list[Span]) -> list[Span]:
    return sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


# ---- unwrapping --------------------------------------------------------------

class _Pieces:
    """A layer made by replacing some runs of its parent, with the way back."""

    def __init__(self) -> None:
        self.parts: list[str] = []
        self.at: list[int] = []       # where a piece begins in the layer
        self.source: list[int] = []   # and in the parent
        self.width: list[int] = []    # characters of the parent for one here; 0: one for one
        self.length = 0

    def add(self, text: str, source: int, width: int) -> None:
        if text:
            self.parts.append(text)
            self.at.append(self.length)
            self.source.append(source)
            self.width.append(width)
            self.length += len(text)

    def back(self, start: int, end: int) -> tuple[int, int]:
        i = bisect_right(self.at, start) - 1
        first = self.source[i] + (0 if self.width[i] else start - self.at[i])
        j = bisect_right(self.at, end - 1) - 1
        last = self.source[j] + (self.width[j] or end - self.at[j])
        return first, last


def _char(escape: str) -> str | None:
    if escape.startswith("&#"):
        body = escape[2:-1]
        code = int(body[1:], 16) if body[0] in "xX" else int(body)
    elif len(escape) == 12:
        high, low = int(escape[2:6], 16), int(escape[8:12], 16)
        code = 0x10000 + ((high - 0xD800) << 10) + (low - 0xDC00)
    else:
        code = int(escape.strip("\\uUx{}"), 16)
    return chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else None


def _unescape(text: str) -> _Pieces | None:
    out, at = _Pieces(), 0
    for m in _ESCAPE.finditer(text):
        char = _char(m[0])
        if char is not None:
            out.add(text[at:m.start()], at, 0)
            out.add(char, m.start(), len(m[0]))
            at = m.end()
    out.add(text[at:], at, 0)
    return out if at else None


#: What a layer must hold for a finding or a further layer.
_HOLDS = re.compile(r"(?i:passw|secret|token|api_?key)|AKIA|[0-9a-f]{32}|%[0-9A-Fa-f]{2}|\\[uUx]|&#|"
                    + _BASE64.pattern)


def _readable(text: str) -> bool:
    return text.isprintable() or all(c.isprintable() or c in "\t\n\r" for c in text)


def _texts(data: bytes) -> Iterator[tuple[str, str, int]]:
    """(text, encoding, bytes before it): every reading of the bytes that
    is text or holds anything. No byte is dropped: what is not UTF-8 is read
    as Latin-1, and bytes with NULs as UTF-16 of both orders, too."""
    try:
        text, encoding = data.decode("utf-8"), "utf-8"
        fine = _readable(text)
    except UnicodeDecodeError:
        text, encoding = data.decode("latin-1"), "latin-1"
        fine = False
    if fine or _HOLDS.search(text):
        yield text, encoding, 0
    if b"\0" in data:
        for skip in (0, 1):
            for encoding in ("utf-16-le", "utf-16-be"):
                text = data[skip:len(data) - (len(data) - skip) % 2].decode(encoding, "surrogatepass")
                if _HOLDS.search(text):
                    yield text, encoding, skip


def _byte_back(text: str, encoding: str, skip: int, back: Back) -> Back:
    """From places in a text to places of its bytes' parent."""
    if encoding == "latin-1" or encoding == "utf-8" and text.isascii():
        return back
    ends: list[np.ndarray] = []

    def at(s: int, e: int) -> tuple[int, int]:
        if not ends:
            codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
            width = (1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF) if encoding == "utf-8"
                     else 2 + 2 * (codes > 0xFFFF))
            ends.append(np.concatenate([[0], np.cumsum(width)]) + skip)
        return back(int(ends[0][s]), int(ends[0][e]))
    return at


class _Source:
    """Pieces of bytes as a file."""

    def __init__(self, pieces: Iterable[bytes]):
        self.pieces, self.held = iter(pieces), memoryview(b"")

    def read(self, n: int = 1 << 16) -> bytes:
        while not self.held:
            piece = next(self.pieces, None)
            if piece is None:
                return b""
            self.held = memoryview(piece)
        out, self.held = bytes(self.held[:n]), self.held[n:]
        return out

    def unread(self, data: bytes) -> None:
        if data:
            self.pieces = chain([self.held], self.pieces) if self.held else self.pieces
            self.held = memoryview(data)

    def peek(self, n: int) -> bytes:
        out = b""
        while len(out) < n and (more := self.read(n - len(out))):
            out += more
        self.unread(out)
        return out


def _codec(head: bytes) -> str:
    if head[:2] == b"\x1f\x8b" or head[:1] == b"\x78" and len(head) > 1 and int.from_bytes(head[:2]) % 31 == 0:
        return "zlib"
    return ("bz2" if head[:3] == b"BZh" else "xz" if head[:6] == b"\xfd7zXZ\x00"
            else "zstd" if head[:4] == b"\x28\xb5\x2f\xfd" else "")


# Where compressed data may begin.
_HEADS = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]|BZh[1-9]|\xfd7zXZ\x00|\x28\xb5\x2f\xfd")
#: Bytes of compressed data that must unpack without a fault before all of it is tried.
TRIED = 256


def _begins(data: bytes) -> Iterator[int]:
    """Where in the bytes compressed data begins, at any offset: a head, and a first
    piece that unpacks (two bytes of a head stand in noise, too)."""
    for m in _HEADS.finditer(data):
        i = m.start()
        if m[0][:1] in b"\x1f\x78":
            try:
                zlib.decompressobj(47).decompress(data[i:i + TRIED], 4 * TRIED)
            except zlib.error:
                continue
        elif m[0][:1] == b"B" and data[i + 4:i + 10] not in (b"1AY&SY", b"\x17rE8P\x90"):
            continue
        yield i


def _bare(data: bytes) -> bool:
    """Whether the bytes are raw deflate (no head), to its end."""
    if len(data) < 16:
        return False
    d = zlib.decompressobj(-15)
    try:
        d.decompress(data[:TRIED], 4 * TRIED)
        if len(data) <= TRIED:
            d.decompress(d.unconsumed_tail)
            return d.eof
    except zlib.error:
        return False
    return True


def _inflate_bare(data: bytes) -> Iterator[bytes]:
    d = zlib.decompressobj(-15)
    try:
        while not d.eof and data:
            yield d.decompress(data, PIECE_BYTES)
            data = d.unconsumed_tail
    except zlib.error:
        return


def _inflate(pieces: Iterable[bytes]) -> Iterator[bytes]:
    """The content of all members, streams or frames, up to the end of the
    data or what is no compressed data."""
    source = _Source(pieces)
    try:
        while codec := _codec(source.peek(6)):
            if codec == "zstd":
                with zstandard.ZstdDecompressor(max_window_size=ZSTD_WINDOW).stream_reader(
                        source, read_across_frames=True, closefd=False) as reader:
                    while out := reader.read(PIECE_BYTES):
                        yield out
                return
            if codec == "zlib":
                d = zlib.decompressobj(47)
                while not d.eof:
                    data = d.unconsumed_tail or source.read()
                    if not data:
                        yield d.flush()
                        return
                    yield d.decompress(data, PIECE_BYTES)
            else:
                d = bz2.BZ2Decompressor() if codec == "bz2" else lzma.LZMADecompressor()
                while not d.eof:
                    data = source.read() if d.needs_input else b""
                    if d.needs_input and not data:
                        return
                    yield d.decompress(data, PIECE_BYTES)
            source.unread(d.unused_data)
            while source.peek(1) == b"\0":  # padding
                block = source.read()
                source.unread(block.lstrip(b"\0"))
    except (zlib.error, OSError, EOFError, ValueError, lzma.LZMAError, zstandard.ZstdError):
        return


#: Bytes that a finding or an encoded run may hold; any other one parts them.
_WITHIN = (b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-=%\\&#;{}:'\". \t\r\n\0")


Back = Callable[[int, int], tuple[int, int]]


class _Layer:
    """The findings of one content and every place where it stands."""

    __slots__ = ("found", "up")

    def __init__(self) -> None:
        self.found: set[Span] = set()
        self.up: list[tuple[_Layer, Back]] = []


def _all(s: int, e: int) -> tuple[int, int]:
    return 0, 1


class Scan:
    """All findings of one text."""

    def __init__(self, text: str, layer_bytes: int = LAYER_BYTES):
        self.layer_bytes = layer_bytes
        self.base = ordered(base_spans(text))
        self.layers, self.cut = 0, 0
        self.known: dict[int, _Layer] = {}
        self.work: deque[Callable[[], None]] = deque()
        root = self._text_layer(text)
        while self.work:
            self.work.popleft()()
        self.spans = ordered(root.found)

    def _text_layer(self, text: str) -> _Layer:
        """The layer of this content, scanned and unwrapped once."""
        key = xxhash.xxh3_128_intdigest(text.encode("utf-8", "surrogatepass"))
        if key not in self.known:
            layer = self.known[key] = _Layer()

            def scan() -> None:
                self.layers += 1
                self._report(layer, set(base_spans(text)))
                self._unwrap(text, layer)

            self.work.append(scan)
        return self.known[key]

    def _report(self, layer: _Layer, spans: set[Span]) -> None:
        """New findings go up to every place of the layer; what a layer has
        already goes no further, which ends cycles."""
        todo = [(layer, spans)]
        while todo:
            layer, spans = todo.pop()
            new = spans - layer.found
            if new:
                layer.found |= new
                todo += [(up, {(k, *back(s, e)) for k, s, e in new}) for up, back in layer.up]

    def _link(self, layer: _Layer, up: _Layer, back: Back) -> None:
        layer.up.append((up, back))
        self._report(up, {(k, *back(s, e)) for k, s, e in layer.found})

    def _push(self, text: str, up: _Layer, back: Back) -> None:
        if text:
            self._link(self._text_layer(text), up, back)

    def _push_packed(self, data: bytes, up: _Layer, whole: Callable[[int], Back]) -> None:
        """Compressed data, wherever it begins in the bytes, is a layer of one place
        (``whole`` of its first byte), whose content is unpacked until it is text."""
        begins = [(i, False) for i in _begins(data)]
        if _bare(data):
            begins.append((0, True))
        for i, bare in begins:
            part = memoryview(data)[i:]
            key = xxhash.xxh3_128_intdigest(part) ^ (1 + bare)
            if key not in self.known:
                layer = self.known[key] = _Layer()
                self.work.append(lambda part=part, layer=layer, bare=bare: self._unpack(
                    bytes(part), layer, bare))
            self._link(self.known[key], up, whole(i))

    def _unpack(self, data: bytes, layer: _Layer, bare: bool = False) -> None:
        pieces, seen, opened = _inflate_bare(data) if bare else _inflate([data]), set(), []
        while True:
            head = bytearray()
            for piece in pieces:
                head += piece
                if len(head) > self.layer_bytes:
                    break
            else:
                if head:
                    self._push_bytes(bytes(head), layer, _all, lambda i: _all)
                break
            key = xxhash.xxh3_128_intdigest(head)
            if key in seen:  # it unpacks to itself
                break
            seen.add(key)
            pieces = self._windows(chain([bytes(head)], pieces), layer, len(data))
            opened.append(pieces)
            if not _codec(head[:6]):
                break
            pieces = _inflate(pieces)  # scanned in passing, and unpacked
        for windows in reversed(opened):
            for _ in windows:
                pass

    def _windows(self, pieces: Iterable[bytes], layer: _Layer, packed: int) -> Iterator[bytes]:
        """The pieces, scanned as texts in windows that end where no finding and
        no encoded run goes on. A run longer than half a window and twice the
        packed data is parted, with an overlap, and counted in ``cut``."""
        buffer, size, parted = bytearray(), self.layer_bytes, False
        for piece in pieces:
            buffer += piece
            if len(buffer) >= size:
                keep = len(buffer) - len(buffer.rstrip(_WITHIN))
                if keep <= len(buffer) // 2:
                    self._window(bytes(buffer[:len(buffer) - keep]), layer)
                elif keep < self.layer_bytes // 2 + 2 * packed:
                    size = len(buffer) + len(buffer) // 4
                    yield piece
                    continue
                else:
                    self._window(bytes(buffer), layer)
                    keep, parted = min(keep, self.layer_bytes // 32), True
                del buffer[:len(buffer) - keep]
                size = max(self.layer_bytes, 2 * keep)
            yield piece
        self._window(bytes(buffer), layer)
        self.cut += parted

    def _window(self, data: bytes, layer: _Layer) -> None:
        """One window, with all that is in it, before the next is unpacked."""
        if len({k for k, *_ in layer.found}) < len(KINDS):
            work, self.work = self.work, deque()
            self._push_texts(data, layer, _all)
            while self.work:
                self.work.popleft()()
            self.work = work

    def _push_texts(self, data: bytes, up: _Layer, back: Back) -> None:
        """Each reading of the bytes as text becomes a layer."""
        for text, encoding, skip in _texts(data):
            self._push(text, up, _byte_back(text, encoding, skip, back))

    def _push_bytes(self, data: bytes, up: _Layer, back: Back, whole: Callable[[int], Back]) -> None:
        self._push_packed(data, up, whole)
        self._push_texts(data, up, back)

    def _unwrap(self, layer: str, up: _Layer) -> None:
        if "%" in layer:
            self._unquote(layer, up)
        if "\\x" in layer:  # bytes, as well as characters of their own
            for m in _BYTES.finditer(layer):
                data = bytes.fromhex(m[0].replace("\\x", ""))
                if not data.isascii() or b"\0" in data:
                    a, b = m.span()
                    self._push_bytes(data, up, lambda s, e, a=a: (a + 4 * s, a + 4 * e),
                                     lambda i, a=a, b=b: lambda s, e: (a + 4 * i, b))
        if ("\\" in layer or "&#" in layer) and (made := _unescape(layer)):
            self._push("".join(made.parts), up, made.back)
        for m in _BASE64.finditer(layer):
            self._base64(m[0], m.start(), up)

    def _base64(self, found: str, start: int, up: _Layer) -> None:
        """One run, joined over its line breaks, at all four alignments: text and
        compressed data are read wherever they begin in the bytes."""
        joined_, at = _Pieces(), 0
        body = found.rstrip("=")
        for m in _BREAK.finditer(body):
            joined_.add(body[at:m.start()], start + at, 0)
            at = m.end()
        joined_.add(body[at:], start + at, 0)
        run = "".join(joined_.parts)
        chars = len(run)
        plain = run.replace("-", "+").replace("_", "/")
        # a payload after "_" or "-" as after "/" (both are "+" or "/" in plain)
        for shift in range(4):
            size = chars - shift
            size -= size % 4 == 1
            if size < 2:
                continue
            data = binascii.a2b_base64(plain[shift:shift + size] + "=" * (-size % 4))

            def back(s: int, e: int, shift: int = shift) -> tuple[int, int]:
                return joined_.back(shift + s * 4 // 3, min(chars, shift + -(-e * 4 // 3)))

            def whole(i: int, shift: int = shift) -> Back:
                w = joined_.back(shift + i * 4 // 3, chars)[0], start + len(found)
                return lambda s, e: w

            self._push_packed(data, up, whole)
            self._push_texts(data, up, back)

    def _unquote(self, layer: str, up: _Layer) -> None:
        out, at = _Pieces(), 0
        for m in _URL.finditer(layer):
            data = bytes.fromhex(m[0].replace("%", ""))
            text = data.decode("utf-8", "surrogateescape")
            if b"\0" in data or not data.isascii() and any("\udc80" <= c <= "\udcff" for c in text):
                a, b = m.span()
                self._push_bytes(data, up, lambda s, e, a=a: (a + 3 * s, a + 3 * e),
                                 lambda i, a=a, b=b: lambda s, e: (a + 3 * i, b))
            out.add(layer[at:m.start()], at, 0)
            source = m.start()
            for char in text:
                raw = char.encode("utf-8", "surrogateescape")
                width = 3 * len(raw)
                out.add(char if not "\udc80" <= char <= "\udcff" else chr(raw[0]), source, width)
                source += width
            at = m.end()
        if at:
            out.add(layer[at:], at, 0)
            self._push("".join(out.parts), up, out.back)


# ---- tables ------------------------------------------------------------------

_OUT = pa.schema([("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()),
                  ("n_hex", pa.int64()), ("base_sha256", pa.string()), ("spans", pa.string()),
                  ("n_layers", pa.int64()), ("n_cut", pa.int64())])


def secret_scan(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base spans by kind, base_sha256, spans (all of
    them), n_layers (decoded ones) and n_cut for every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                scan = Scan(text)
                kinds = [k for k, _, _ in scan.base]
                rows.append((doc, *(kinds.count(k) for k in KINDS), sha256_hex(joined(scan.base)),
                             joined(scan.spans), max(0, scan.layers - 1), scan.cut))
            columns = list(zip(*rows)) or [[]] * len(_OUT)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _OUT)],
                                             schema=_OUT)

    return id_text(docs).mapInArrow(
        run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, "
             "spans string, n_layers long, n_cut long")


def redact(docs: DataFrame, marker: str = "[REDACTED]", text_col: str = "text") -> DataFrame:
    """The documents with all findings replaced by ``marker``; rows and other
    columns stay, NULL texts stay NULL."""
    ship_package(docs.sparkSession)
    at = docs.columns.index(text_col)

    def clean(text: str | None) -> str | None:
        spans = [(s, e) for _, s, e in Scan(text).spans] if text else []
        return cut_spans(text, spans, marker) if spans else text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            columns = list(b.columns)
            columns[at] = pa.array([clean(t) for t in b.column(at).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=b.schema.names)

    return docs.mapInArrow(released(run), docs.schema)
