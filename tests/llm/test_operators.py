"""Operators against brute force, exact round trips or held-out accuracy."""

from __future__ import annotations

import base64
import bz2
import collections
import gzip
import hashlib
import lzma
import random
import re
import zlib

import numpy as np
import pytest
import zstandard

from daybook.llm import (decontaminate, jaccard, nearest, packing, private, quality, queries, secrets,
                         shards, toxicity, url_rules)
from tests.oracle_compare import compare, duck

SCHEMA = "doc_id long, text string, lang string, _id string, _text int, spans string"


def table(spark, rows):
    """Rows (id, text) with extra columns whose names clash with inner ones."""
    return spark.createDataFrame([(i, t, "en", "x", 1, "y") for i, t in rows], SCHEMA).repartition(3)


ODD = [(None, "a b c"), (1, None), (2, ""), (3, " \n"), (4, "one"), (4, "one"), (5, "ü" * 50_000),
       (6, "word " * 30_000), (7, "Ünïcode K ſ 𝔘 \x00 x")]


# ---- 1 secrets -----------------------------------------------------------------

def test_base_spans_equal_plain_patterns():
    rng = random.Random(1)
    parts = ["password", "PassWD", "secret", "token", "api_key", "apikey", "=", ": ", "'", '"', " ",
             "AKIA", "ABCDEFGH1234", "deadbeef" * 4, "abc", "tok", "0123456789abcdef", "é", "\n", "."]
    for _ in range(400):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 25)))
        want = [("assign", *m.span()) for m in re.finditer(
            r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
            text) if len(m[2]) >= 8]
        want += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
        want += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
        assert sorted(secrets.base_spans(text)) == sorted(want)


def test_nested_layers_are_mapped_back():
    secret = "token=abcdefgh12345678"
    inner = base64.b64encode(gzip.compress(secret.encode())).decode()
    text = f"see {inner} end"
    scan = secrets.Scan(text)
    assert ("assign", 4, 4 + len(inner)) in scan.spans and not scan.base
    twice = base64.b64encode(f"x {inner} y".encode()).decode()
    assert any(k == "assign" for k, *_ in secrets.Scan(twice).spans)
    url = "a password%3Dabcdefgh%31%32 b"
    s, e = next((s, e) for k, s, e in secrets.Scan(url).spans if k == "assign")
    assert url[s:e] == "password%3Dabcdefgh%31%32"
    esc = r"é pass\u0077ord=abcdefgh12 z"
    s, e = next((s, e) for k, s, e in secrets.Scan(esc).spans if k == "assign")
    assert esc[s:e] == r"pass\u0077ord=abcdefgh12"
    plain = base64.b64encode(b"hello secret=abcdefgh99 bye").decode()
    s, e = next((s, e) for k, s, e in secrets.Scan(plain).spans if k == "assign")
    assert b"secret=abcdefgh99" in base64.b64decode(plain[s // 4 * 4: -(-e // 4) * 4])
    bomb = base64.b64encode(zlib.compress(b"a" * 100_000)).decode()
    assert secrets.Scan(bomb, layer_bytes=1000).cut == 1


def test_repeated_blobs_are_found_at_every_place():
    secret = "token=abcdefgh12345678"
    plain = base64.b64encode(secret.encode()).decode()
    packed = base64.b64encode(gzip.compress(secret.encode())).decode()
    outer = base64.b64encode(f"< {packed} >".encode()).decode()  # a packed blob at two depths
    url = "password%3Dabcdefgh%31%32"
    for blob in (plain, packed, outer, url):
        text = f"a {blob} b {blob} c {packed} d {blob}"
        spans = secrets.Scan(text).spans
        for m in re.finditer(re.escape(blob), text):
            assert any(k == "assign" and m.start() <= s < e <= m.end() for k, s, e in spans), (blob, m)
        at = text.index(f" c {packed}") + 3
        assert ("assign", at, at + len(packed)) in spans
    scan = secrets.Scan(" ".join([packed] * 50))
    assert len(scan.spans) == 50 and scan.layers == 2  # unpacked once


def test_layers_of_any_characters_are_scanned():
    secret = "token=abcdefgh12345678"
    for extra in ("\u00a0", "\u3000", "\u200b", "\u200d", "\ufeff", "\u00ad", "\u2028", "\f", "\0", "é", "𝔘"):
        for encoding in ("utf-8", "utf-16", "utf-16-le", "utf-16-be", *["latin-1"] * (extra <= "\xff")):
            data = f"{extra}a {extra} {secret} {extra}b".encode(encoding)
            packed = base64.b64encode(gzip.compress(data)).decode()
            assert ("assign", 2, 2 + len(packed)) in secrets.Scan(f"x {packed} y").spans, (extra, encoding)
            plain = base64.b64encode(data).decode()
            want = secret.encode(encoding if encoding != "utf-16" else "utf-16-le")
            held = [base64.b64decode(plain[(s - 2) // 4 * 4: -(-(e - 2) // 4) * 4])
                    for k, s, e in secrets.Scan(f"x {plain} y").spans if k == "assign"]
            # text in one byte order may also be read in the other, one byte off
            assert any(want in h and len(h) <= len(want) + 4 for h in held) and len(held) <= 2
    noise = base64.b64encode(b"\xff\x80 " + secret.encode() + b" \xc3").decode()
    assert len(secrets.Scan(noise).spans) == 1
    url = "caf%E9%74oken%3Dabcdefgh1234 %E9"
    (_, s, e), = secrets.Scan(url).spans
    assert url[s:e] == "%74oken%3Dabcdefgh1234"


def test_base64_of_any_alignment_and_wrapping():
    secret = b"token=abcdefgh12345678"
    rng = random.Random(8)
    filler = bytes(rng.randrange(33, 127) for _ in range(300))
    packers = (lambda x: x, gzip.compress, zlib.compress, bz2.compress, lzma.compress,
               zstandard.ZstdCompressor().compress)
    for pack in packers:
        payload = base64.b64encode(pack(filler + b" " + secret + b" ")).decode()
        for prefix in ("", "api/v1/", "a/", "ab/", "abc/", "x_", "id-", "abcd_ef-"):
            for width, end in ((10 ** 6, "\n"), (76, "\n"), (64, "\r\n"), (61, "\n  ")):
                body = end.join(payload[i:i + width] for i in range(0, len(payload), width))
                text = f"see: {prefix}{body}\n, bye"
                spans = [(s, e) for k, s, e in secrets.Scan(text).spans if k == "assign"]
                if pack is packers[0]:
                    assert len(spans) == 1 and len(text[slice(*spans[0])].replace(end, "")) in range(30, 34)
                else:
                    at = text.index(body)
                    assert (at, at + len(body)) in spans, (pack, prefix, width)
    two = "api/v1/" + base64.b64encode(secret).decode()
    assert any(k == "assign" for k, *_ in secrets.Scan(two).spans)


def test_compressed_data_is_read_to_its_end():
    secret = b"token=abcdefgh12345678"
    rng = random.Random(9)
    long = " ".join(f"{rng.randrange(10 ** 9)}, é" for _ in range(3000)).encode()
    inner = base64.b64encode(gzip.compress(secret + bytes(rng.randrange(256) for _ in range(3000))))
    filler = bytes(rng.randrange(33, 127) for _ in range(300)) + b" "
    packers = (gzip.compress, zlib.compress, bz2.compress, lzma.compress, zstandard.ZstdCompressor().compress)
    for pack in packers:
        several = pack(b"first") + pack(b"second") + pack(filler + secret)
        far = pack(long + b" " + secret + b", end " + long)
        nested = pack(long + b" " + inner + b", end " + long)
        deep = pack(pack(bytes(rng.randrange(256) for _ in range(5000)) + b" " + secret))
        trailing = pack(gzip.compress(bytes(rng.randrange(256) for _ in range(5000))) + b", " + secret)
        for data in (several, far, nested, deep, trailing):
            text = base64.b64encode(data).decode()
            for size in (1000, 5000, secrets.LAYER_BYTES):
                scan = secrets.Scan(text, layer_bytes=size)
                assert ("assign", 0, len(text)) in scan.spans and scan.cut == 0, (pack, size)
    wide = zstandard.ZstdCompressor(compression_params=zstandard.ZstdCompressionParameters(
        window_log=27, enable_ldm=True)).compressobj()
    data = wide.compress(b"x, " * 100) + wide.compress(secret) + wide.flush()
    text = base64.b64encode(data).decode()
    assert ("assign", 0, len(text)) in secrets.Scan(text).spans


def test_secret_table_and_redaction(spark):
    rows = [*ODD, (9, "my password = hunter2hunter2 ok"), (9, "my password = hunter2hunter2 ok")]
    got = secrets.secret_scan(table(spark, rows)).collect()
    assert len(got) == len(rows)
    empty = hashlib.sha256(b"").hexdigest()
    assert all((r.base_sha256 == empty) == (r.n_assign + r.n_access + r.n_hex == 0) for r in got)
    assert [r.spans for r in got if r.doc_id == 9] == ["assign:3:28"] * 2
    clean = secrets.redact(table(spark, rows))
    assert clean.columns == table(spark, rows).columns
    texts = [r.text for r in clean.collect() if r.doc_id == 9]
    assert texts == ["my [REDACTED] ok"] * 2
    assert secrets.secret_scan(table(spark, []).limit(0)).count() == 0


# ---- 2 private data ---------------------------------------------------------------

def plain_private(text):
    digits = lambda s: re.sub("[^0-9]", "", s)

    def luhn(d):
        return sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4)
                   for i, c in enumerate(reversed(d))) % 10 == 0
    out = [("email", *m.span()) for m in re.finditer(
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
            if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 8 <= len(digits(m[0])) <= 15]
    return ",".join(f"{k}:{s}:{e}" for k, s, e in out)


def test_private_base_equals_plain_patterns(spark):
    rng = random.Random(2)
    parts = ["a.b", "@", "x-1", ".", "com", "_", " ", "12", "255", "256", "007", "4497672581733027",
             "4", "-", "+1", "(830) 555", "-5433", "é", "𝔘", "+", "1.2.3.4", "\n", "z@y.co"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randrange(1, 22)))) for i in range(300)]
    rows += [(1000 + i, t) for i, (_, t) in enumerate(ODD)]
    rows.append((2000, "a" * 30_000 + "@" + ".b" * 20_000 + " " + "1" * 30_000))
    got = {r.doc_id: r for r in private.digest(private.private_spans(
        private.plain(table(spark, rows)))).collect()}
    for i, text in rows:
        want = plain_private(text or "")
        assert got[i].base_sha256 == hashlib.sha256(want.encode()).hexdigest(), text
        assert ",".join(x for x in got[i].spans.split(",") if not x.startswith("term")) == want


def test_disclosing_terms_are_found_and_generalised(spark):
    filler = "common words that everybody writes in every single document here"
    rows = [(i, f"{filler} number{i % 7}") for i in range(60)]
    rows += [(100 + i, f"{filler} write to jo@acme.org about zephyrion project") for i in range(3)]
    rows += [(200, "unrelated zephyric and zephyrs text"), (201, "more zephyric zephyrs"),
             (202, "zephyrs"), (203, "zephyrs zephyric"), (204, "zephyrs"), (205, "zephyrs")]
    docs = private.plain(table(spark, rows))
    got = {r.doc_id: r for r in private.digest(private.private_spans(docs)).collect()}
    text = dict(rows)
    for i in range(100, 103):
        terms = [x.split(":") for x in got[i].spans.split(",") if x.startswith("term")]
        words = {text[i][int(s):int(e)] for _, s, e in terms}
        assert "zephyrion" in words and "common" not in words
        assert got[i].n_generalised >= 1
    assert all(got[i].spans == "" for i in range(60)) and got[200].spans == ""
    clean = {r["_id"]: r.text for r in private.sanitise(docs).collect()}
    assert "jo@acme.org" not in clean[100] and "zephyrion" not in clean[100]
    assert "[email]" in clean[100] and "zep*" in clean[100] and clean[0] == text[0]
    empty = private.plain(table(spark, rows).limit(0))
    assert private.digest(private.private_spans(empty)).count() == 0


# ---- 3 join -------------------------------------------------------------------------

def brute_components(rows):
    hashes = jaccard.WordHashes()
    sets = {d: frozenset(jaccard.shingle_set(t or "", hashes).tolist()) for d, t in rows}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def edited(rng, count):
    rows = []
    for _ in range(count):
        n = rng.choice([1, 2, 3, 5, 6, 8, 9, 12, 15, 20, 30, 40, 70, 130, 300])
        base = [f"w{rng.randrange(10 ** 6)}" for _ in range(n + 4)]
        for _ in range(rng.randrange(1, 6)):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
                i = rng.randrange(len(words))
                kind = rng.randrange(3)
                if kind == 0:
                    words[i] = f"x{rng.randrange(10 ** 6)}"
                elif kind == 1 and len(words) > 1:
                    del words[i]
                else:
                    words.append(f"y{rng.randrange(10 ** 6)}")
            rows.append((len(rows), " ".join(words)))
    return rows


def test_join_equals_brute_force(spark):
    rng = random.Random(3)
    rows = edited(rng, 60)
    passage = " ".join(f"p{i}" for i in range(60))  # shared by texts that are not alike
    rows += [(10_000 + i, passage + " " + " ".join(f"q{i}_{j}" for j in range(rng.choice([20, 40, 60]))))
             for i in range(40)]
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in jaccard.jaccard_components(table(spark, rows)).collect()}
    assert got == brute_components(rows)


def test_links_equal_brute_force(spark, monkeypatch):
    rng = random.Random(5)
    rows = edited(rng, 25)
    base = [f"n{i}" for i in range(80)]
    for i in range(60):  # one group: near copies, not all similar to one another
        words = [w if rng.random() > 0.03 else f"z{rng.randrange(10 ** 6)}" for w in base]
        rows.append((20_000 + i, " ".join(words)))
    rows += [(30_000 + i, rows[-1][1]) for i in range(3)] + [(40_000, ""), (40_001, None)]
    hashes = jaccard.WordHashes()
    sets = [(d, frozenset(jaccard.shingle_set(t or "", hashes).tolist())) for d, t in rows]
    want = {d: sum(100 * len(s & r) >= 80 * len(s | r) for e, r in sets if e != d and s) for d, s in sets}
    for block in (256, 8):
        monkeypatch.setattr(jaccard, "LINK_BLOCK", block)
        monkeypatch.setattr(jaccard, "LINK_SHINGLES", 4096 if block > 8 else 50)
        got = {r.doc_id: r.n_links for r in jaccard.jaccard_components(table(spark, rows)).collect()}
        assert got == want


def test_join_of_odd_rows(spark):
    got = collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in
                              jaccard.jaccard_components(table(spark, ODD)).collect())
    assert got[(4, 1, 4)] == 2 and got[(1, 0, 1)] == 1 and got[(None, 1, None)] == 1
    assert sum(got.values()) == len(ODD)
    kept = jaccard.one_of_each_group(table(spark, ODD))
    assert kept.columns == SCHEMA.replace(" long", "").replace(" string", "").replace(
        " int", "").split(", ") and kept.count() == len(ODD) - 1
    assert jaccard.jaccard_components(table(spark, ODD).limit(0)).count() == 0


def test_pigeonhole_guarantee():
    """Similar sets share a looked-up row, whatever rows are given up."""
    rng = np.random.default_rng(4)
    for _ in range(300):
        n = int(rng.integers(1, 400))
        r = np.unique(rng.integers(0, 2 ** 63, n).astype(np.uint64) * np.uint64(2) + np.uint64(1))
        drop = int(rng.integers(0, len(r) // 4 + 1))
        keep = rng.permutation(r)[drop:]
        s = np.unique(np.concatenate([keep, rng.integers(0, 2 ** 63, len(r) // 4 - drop).astype(np.uint64)]))
        if not len(s):
            continue
        common = len(np.intersect1d(r, s))
        if 100 * common < 80 * (len(r) + len(s) - common):
            continue
        small, large = (r, s) if len(r) <= len(s) else (s, r)
        index, own, forced = set(), [], set()
        for h, role in jaccard.signatures(large, 7):
            if role & jaccard.INDEX:
                index.update(h.tolist())
        for h, role in jaccard.signatures(small, 7):
            if role & jaccard.PROBE:
                own += h.tolist()
            if role & jaccard.FORCED:
                forced.update(h.tolist())
        shared = [h for h in own if h in index]
        assert len(shared) > max(0, jaccard.slack(small)) or forced & index


# ---- 4 decontamination ------------------------------------------------------------------

def brute_windows(text, items):
    words = decontaminate.words_of(text or "")
    hit, names = set(), set()
    for item, other in items:
        w = decontaminate.words_of(other or "")
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            for p in range(len(words) - n + 1):
                if words[p:p + n] == w[i:i + n]:
                    hit.update(range(p, p + n))
                    names.add(str(item))
    return len(words), len(hit), sorted(names)


def test_windows_equal_brute_force(spark):
    rng = random.Random(5)
    word = lambda: rng.choice("abcdefgh") * rng.randrange(1, 3)
    items = [(i, " ".join(word() for _ in range(rng.randrange(0, 25)))) for i in range(12)]
    items += [(12, "Alpha, BETA"), (12, "Alpha, BETA"), (13, None), (14, "  ")]
    rows = []
    for i in range(60):
        words = [word() if rng.random() < 0.6 else f"o{rng.randrange(99)}" for _ in range(rng.randrange(0, 80))]
        if rng.random() < 0.6:
            at, other = rng.randrange(len(words) + 1), rng.choice(items[:13])[1]
            words[at:at] = other.split()[rng.randrange(3):]
        rows.append((i, " ".join(words)))
    rows += [(100 + i, t) for i, (_, t) in enumerate(ODD)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for size in (decontaminate.PHRASE_BYTES, 200):  # one block of items, or several
        got = {r.doc_id: r for r in decontaminate.decontaminate(
            table(spark, rows), bench, phrase_bytes=size).collect()}
        for i, text in rows:
            n, hit, names = brute_windows(text, items)
            r = got[i]
            assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, hit, len(names), hit > 0)
            assert r.items_sha256 == hashlib.sha256(",".join(names).encode()).hexdigest()
    left = decontaminate.remove_windows(table(spark, rows), bench)
    assert decontaminate.decontaminate(left, bench).filter("contaminated").count() == 0
    none = bench.limit(0)
    assert decontaminate.decontaminate(table(spark, rows), none).filter("contaminated").count() == 0


def test_index_slices_long_texts():
    rng = random.Random(6)
    words = [rng.choice("abc") for _ in range(3000)]
    items = [(1, " ".join(words[500:530])), (2, " ".join(words[1490:1512])), (3, "a b c a b")]
    phrases = decontaminate.make_phrases(items)
    (spans, names, n), = decontaminate.scan([words], 1, phrases, shard_words=100)
    flat = [x for s in spans for x in s]
    assert n == 3000 and sum(e - s for s, e in decontaminate.covered(flat)) == brute_windows(
        " ".join(words), items)[1] and names >= {"1", "2"}


# ---- 5 toxicity ---------------------------------------------------------------------------

def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{d}/labels.parquet")
    out = toxicity.toxicity(spark.read.parquet(f"{d}/documents.parquet"), labels, max_rows=600)
    rows = out.filter("held_out").join(labels, "doc_id").select("score", "toxic", "predicted").collect()
    assert len(rows) > 300 and np.mean([r.predicted == r.toxic for r in rows]) > 0.93
    ids = out.select("doc_id", "held_out").limit(50).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in ids)


def test_toxicity_of_odd_rows(spark):
    labels = spark.createDataFrame([(4, 0, 1), (5, 0, 0), (None, 1, None)],
                                   "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(table(spark, ODD), labels).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    nothing = toxicity.toxicity(table(spark, ODD), labels.limit(0)).collect()
    assert len({r.score for r in nothing}) == 1
    assert toxicity.toxicity(table(spark, ODD).limit(0), labels).count() == 0
    assert toxicity.drop_toxic(table(spark, ODD), labels.limit(0)).columns == table(spark, ODD).columns


# ---- 6 URL rules ------------------------------------------------------------------------------

URLS = ["http://a.example.net/en/x", "http://example.net/de", "https://net/", "https://net", "x://ORG/fr/",
        "no scheme", None, "", "http://b.org/fr", "http://b.org/fr/", "http://u@b.org:80/fr/1", "://net/q?x#y",
        "http://example.com/de/1", "http://example.com?/de/", "http://notexample.com/de/", "http://a..net//"]


def test_url_rules_equal_sql_and_join(spark, sf_small):
    con = duck(sf_small)
    r = compare(spark, con, queries.op6_url_rules, queries.ORACLE["op6_url_rules"], sf_small)
    assert r["match"], r
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS)], "page_id long, url string, rule string")
    by_trie = {tuple(x) for x in url_rules.judge(pages, queries.URL_RULES).collect()}
    by_join = {tuple(x) for x in url_rules.judge(pages, queries.URL_RULES, max_rule_bytes=0).collect()}
    assert by_trie == by_join and len(by_trie) == len(URLS)
    verdict = {x[0]: x[4] for x in by_trie}
    assert [verdict[i] for i in (0, 1, 2, 3, 4, 12, 14)] == [
        "allow", "block", "block", "allow", "allow", "block", "allow"]
    assert url_rules.judge(pages, []).filter("verdict = 'allow'").count() == len(URLS)
    assert url_rules.judge(pages.limit(0), queries.URL_RULES).count() == 0


def test_longest_rule_wins():
    rules = [url_rules.split_rule(*r) for r in (("a.com", "block"), ("a.com/x", "allow"), ("a.com/x/", "block"),
                                                ("b.a.com", "allow"), ("a.com/x", "block"))]
    trie = url_rules.build_trie(rules)
    assert url_rules.match(trie, "a.com", "/xy") == ("a.com/x", "block")
    assert url_rules.match(trie, "a.com", "/x/y") == ("a.com/x/", "block")
    assert url_rules.match(trie, "c.b.a.com", "") == ("b.a.com", "allow")
    assert url_rules.match(trie, "xa.com", "/") is None


# ---- 7 packing ----------------------------------------------------------------------------------

def test_packing_round_trip(spark, sf_small):
    from tokenizers import Tokenizer
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()
    rows = [tuple(r) for r in docs] + [(10_000 + i, t) for i, (_, t) in enumerate(ODD)] + [
        (None, "a null id"), (20_000, "same"), (20_000, "same"), (20_001, "日本 <|endoftext|> text  x")]
    out = packing.pack(table(spark, rows), group_pieces=200).collect()
    t = Tokenizer.from_file(packing.default_tokenizer())
    want = collections.Counter()
    for i, text in rows:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        for s in range(0, len(ids), 1024):
            part = ids[s:s + 1024]
            want[(i, s, len(part), zlib.crc32(part.tobytes()), len(ids))] += 1
    assert want == collections.Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in out)
    sequences = collections.defaultdict(list)
    for r in out:
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024
    assert sum(r.length for r in out) / (1024 * len(sequences)) > 0.97
    assert packing.pack(table(spark, rows).limit(0)).count() == 0


def test_first_fit_by_tree_equals_a_scan():
    rng = random.Random(7)
    sizes = sorted((rng.randrange(1, 1025) for _ in range(500)), reverse=True)
    bins, want = [], []
    for s in sizes:
        b = next((i for i, used in enumerate(bins) if used + s <= 1024), len(bins))
        bins += [0] * (b == len(bins))
        want.append((b, bins[b]))
        bins[b] += s
    assert packing.first_fit_decreasing(sizes) == want


# ---- 8 nearest --------------------------------------------------------------------------------------

def exact_nearest(rows, k=10):
    out = {}
    for q, v in rows:
        if q % 100 == 0:
            d = sorted((float(np.sqrt(((np.array(w, float) - np.array(v, float)) ** 2).sum())), i)
                       for i, w in rows if i != q)
            out[q] = d[:k]
    return out


def test_recall_and_distances(spark):
    table_ = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table_.collect()]
    want = exact_nearest(rows)
    # small shards, so that the forest decides
    got = collections.defaultdict(list)
    for r in nearest.nearest(table_, shard=1000, verify=0.2).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.score, r.vec_id))
    hits = sum(len({i for _, i in want[q]} & {i for _, i in got[q]}) for q in want)
    assert hits / sum(len(x) for x in want.values()) >= 0.9
    vectors = dict(rows)
    for q in list(want)[:3]:
        for score, i in got[q]:
            assert abs(score - np.linalg.norm(np.array(vectors[q], float) - np.array(vectors[i], float))) < 1e-9


@pytest.mark.parametrize("n", [2000, 2600, 8192])
def test_recall_at_production_defaults(n):
    rng = np.random.default_rng(1)
    v = rng.standard_normal((n, 64))
    v /= np.linalg.norm(v, axis=1)[:, None]
    found = nearest.search_shard(np.arange(n), v, v[:40], 11)
    want = [np.argsort(((v - q) ** 2).sum(axis=1))[1:11] for q in v[:40]]
    assert sum(len(np.intersect1d(w, c)) for w, (c, _) in zip(want, found)) / 400 >= 0.92


def test_nearest_of_odd_vectors(spark):
    rows = [(i, [1.0, 2.0]) for i in range(0, 40)] + [
        (100, [1.0, 2.5]), (200, None), (300, [0.0, 0.0]), (400, [1.0, None]), (500, [float("nan"), 1.0]),
        (None, [1.0, 1.0]), (100, [1.0, 2.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in nearest.nearest(df).collect()}
    assert {q for q, _ in got} == {0, 100}
    assert [got[(0, k)][0] for k in range(1, 11)] == list(range(1, 11))
    assert [got[(100, k)] for k in range(1, 11)] == [(i, 0.5) for i in range(10)]
    assert nearest.nearest(df.limit(0)).count() == 0
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [4.0])], "vec_id long, embedding array<double>")
    assert [r.vec_id for r in nearest.nearest(few).orderBy("rank").collect()] == [1, 2]


# ---- 9 quality ------------------------------------------------------------------------------------------

@pytest.mark.parametrize("k", [0, 1, 7, 500, 999, 1000])
def test_top_k_is_exact(spark, k):
    rng = random.Random(8)
    rows = [(i, rng.choice([0.0, 1.0, rng.gauss(0, 5)])) for i in range(1000)]
    df = spark.createDataFrame(rows, "doc_id long, key double")
    want = sorted(rows, key=lambda r: (-r[1], r[0]))[:k]
    for last in (3, 10_000):
        got = quality.top_k(df, k, last_bin=last, bins=8).collect()
        assert sorted(map(tuple, got)) == sorted(want)


def test_quality_prefers_good_documents(spark):
    d = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{d}/labels.parquet")
    docs = spark.read.parquet(f"{d}/documents.parquet")
    kept = {r.doc_id for r in quality.resample(docs, labels).collect()}
    known = {r.doc_id: r.quality for r in labels.collect()}
    good = [i in kept for i, y in known.items() if y]
    bad = [i in kept for i, y in known.items() if not y]
    assert np.mean(good) > 0.95 and np.mean(bad) < 0.4
    assert quality.resample(table(spark, ODD), labels.limit(0)).count() == round(0.5 * len(ODD))
    assert quality.resample(docs.limit(0), labels).count() == 0


# ---- 10 shards ----------------------------------------------------------------------------------------------

def test_shards(spark, sf_small):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()]
    rows += [(10_000 + i, t) for i, (_, t) in enumerate(ODD[:5])] + [(7, "hot row")] * 3000 + [(None, None)] * 4
    out = shards.shard(table(spark, rows)).collect()
    want = collections.Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert want == collections.Counter((r.doc_id, r.size, r.text_crc32) for r in out)
    by = collections.defaultdict(list)
    for r in out:
        by[r.shard].append(r)
    assert set(by) == set(range(16))
    for part in by.values():
        assert sorted(r.slot for r in part) == list(range(len(part)))
    sizes = [sum(r.size for r in part) for part in by.values()]
    assert max(sizes) / (sum(sizes) / 16) < 1.1
    assert shards.shard(table(spark, rows).limit(0)).count() == 0


def test_rebalancing_moves_little():
    rng = random.Random(9)
    loads = {(s, 0): rng.randrange(50, 150) for s in range(4096)}
    first = shards.assign(loads, 16)
    grown = shards.rebalance(first, loads, 17)
    moved = sum(loads[u] for u in loads if first[u] != grown[u]) / sum(loads.values())
    assert moved < 0.08 and set(grown.values()) == set(range(17))


# ---- pipeline ------------------------------------------------------------------------------------------------

def test_pipeline_stages(spark, sf_small):
    import corpus_pipeline as P
    from daybook.llm.common import read_table
    docs = read_table(spark, sf_small, "documents")
    columns = docs.columns
    toxic = {r.doc_id for r in queries.op5_toxicity(spark, sf_small).filter("predicted = 1").collect()}
    a = P.drop_toxic(spark, docs, sf_small).cache()
    assert {r.doc_id for r in a.collect()} == {r.doc_id for r in docs.collect()} - toxic
    b = P.drop_near_copies(spark, a, sf_small).cache()
    assert {r.doc_id for r in b.collect()} == {
        c for _, c in brute_components([(r.doc_id, r.text) for r in a.collect()]).values()}
    c = P.cut_benchmark(spark, b, sf_small).cache()
    assert decontaminate.decontaminate(c, read_table(spark, sf_small, "benchmark")).filter("contaminated").count() == 0
    d = P.redact_secrets(spark, c, sf_small).cache()
    assert secrets.secret_scan(d).filter("spans != ''").count() == 0
    assert all(x.columns == columns for x in (a, b, c, d)) and d.count() == b.count()
    last = P.run(spark, sf_small)
    assert last.select("doc_id").distinct().count() == d.count()


def test_jaccard_sketches_bound_the_difference():
    rng = np.random.default_rng(5)
    for n in (1, 30, 400, 3000):
        a = jaccard.distinct(rng.integers(0, 1 << 63, n).astype(np.uint64))
        for change in (0, 1, n // 9, n // 2):
            b = jaccard.distinct(np.concatenate([a[change:], rng.integers(0, 1 << 63, change).astype(np.uint64)]))
            bits = sum(int(x).bit_count() for x in (jaccard.sketch(a) ^ jaccard.sketch(b)).view(np.uint64))
            assert bits <= len(np.setxor1d(a, b))
    assert not jaccard.sketch(np.zeros(0, dtype=np.uint64)).any()
    assert len(jaccard.distinct(np.zeros(0, dtype=np.uint64))) == 0
