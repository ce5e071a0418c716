"""Layers wherever they begin in decoded bytes, and the time of noise."""

from __future__ import annotations

import base64
import bz2
import gzip
import lzma
import random
import time
import zlib

import pytest
import zstandard

from daybook.llm import secrets

SECRET = b"id 7 token=abcdefgh12345678 end"


def packed():
    raw = zlib.compressobj(wbits=-15)
    return {"gzip": gzip.compress(SECRET), "zlib": zlib.compress(SECRET), "bz2": bz2.compress(SECRET),
            "xz": lzma.compress(SECRET), "zstd": zstandard.compress(SECRET),
            "raw": raw.compress(SECRET) + raw.flush()}


def wrappings(data):
    yield "url", "".join(f"%{b:02x}" for b in data)
    yield "escapes", "".join(f"\\x{b:02X}" for b in data)
    yield "base64", base64.b64encode(data).decode()
    yield "base64 of a url", base64.urlsafe_b64encode(data).decode()


@pytest.mark.parametrize("kind", list(packed()))
def test_packed_data_behind_any_prefix_is_found(kind):
    data = packed()[kind]
    for prefix in (b"", b"xx", b"\n ", b"\x00", b"\xff\xfe\xfd", b"a" * 7, b"abc\x80" * 5):
        if kind == "raw" and prefix:
            continue  # raw deflate has no head: it is read where a run begins
        for name, text in wrappings(prefix + data):
            scan = secrets.Scan(f"see {text} there")
            assert any(k == "assign" and 4 <= s < e <= 4 + len(text) for k, s, e in scan.spans), (name, prefix)


def test_nested_layers_in_escapes():
    inner = gzip.compress(base64.b64encode(b"zz" + gzip.compress(SECRET)))
    text = "".join(f"\\x{b:02x}" for b in b"\r\n" + inner)
    assert secrets.Scan(text).spans and not secrets.Scan(text).base


def test_noise_is_read_in_time_and_holds_nothing():
    rng = random.Random(1)
    data = rng.randbytes(4_000_000)
    text = base64.b64encode(data).decode()
    t = time.process_time()
    scan = secrets.Scan(text)
    assert time.process_time() - t < 20 and scan.base == []
    assert sum(1 for _ in secrets._begins(data)) < 20
    # a payload in the middle of noise
    mixed = data[:50_001] + gzip.compress(SECRET) + data[50_001:60_000]
    assert any(k == "assign" for k, *_ in secrets.Scan(base64.b64encode(mixed).decode()).spans)
