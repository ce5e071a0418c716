"""Periodic runs against brute force."""

from __future__ import annotations

import hashlib
import random
import zlib
from fractions import Fraction

from daybook.llm import periodic_runs as P
from tests.llm.test_operators import ODD, table


def brute_runs(words, least=6, exponent=4):
    """All stretches of smallest period q, straight from the definition."""
    n, seen = len(words), {}
    for q in range(1, n // exponent + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            b = i
            while i < n and words[i] == words[i - q]:
                i += 1
            start, length = b - q, i - b + q
            if length >= max(least, exponent * q):
                seen.setdefault((start, length), q)  # the smallest period comes first
    return sorted(((s, n_, q) for (s, n_), q in seen.items()), key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    words = [] if text is None else [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", text)]
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    n = len(words)
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    drop = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = (lambda s: hashlib.sha256(s.encode()).hexdigest())
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join("%d,%d,%d\n" % r for r in runs)),
            sha(" ".join(w for i, w in enumerate(words) if i not in drop)))


def test_runs_equal_brute_force_on_random_words():
    rng = random.Random(4)
    texts = []
    for _ in range(1500):
        words = []
        for _ in range(rng.randrange(1, 5)):
            unit = [rng.choice("ab" if rng.random() < 0.5 else "abcdefgh") for _ in range(rng.randrange(1, 12))]
            words += unit * rng.randrange(1, 9) + unit[: rng.randrange(len(unit))]
            words += [rng.choice("abxyz") for _ in range(rng.randrange(4))]
        texts.append([w.encode() for w in words])
    texts += [[], [b"a"], [b"a"] * 5, [b"a"] * 6, [b"a", b"b"] * 4, [b"a", b"b"] * 3, [b"a", b"b", b"a"] * 400]
    for least, exponent in ((6, 4), (1, 3), (20, 5)):
        got = P.find_runs(texts, least, exponent)  # one batch: neighbours must not touch
        for words, runs in zip(texts, got):
            assert runs == brute_runs(words, least, exponent), words


def test_frequent_words_and_long_texts_stay_cheap():
    rng = random.Random(5)
    words = [b"the" if rng.random() < 0.5 else b"w%d" % rng.randrange(9) for _ in range(300_000)]
    line = [b"v%d" % i for i in range(700)]
    words[100_000:100_000 + 700 * 30] = line * 30
    runs = P.find_runs([words])[0]
    assert any(q == 700 and n >= 700 * 30 for _, n, q in runs)
    assert P.find_runs([[b"a"] * 1_000_000]) == [[(0, 1_000_000, 1)]]


def test_query_rows_equal_brute_force(spark):
    rng = random.Random(6)
    rows = list(ODD) + [(None, None), (8, "a b \x1c a  " * 9), (9, "x y " * 40)]
    rows += [(i, " ".join(rng.choice("abcde") for _ in range(rng.randrange(0, 80)))) for i in range(100, 260)]
    docs = table(spark, rows)
    out = P.digest(P.runs(docs, read=P.words_with_planted_repeat))
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli",
                           "runs_sha256", "collapsed_sha256"]
    key = (lambda r: tuple((x is None, x) for x in r))
    assert sorted(map(tuple, out.collect()), key=key) == sorted((brute_row(*r) for r in rows), key=key)
    assert sum(r.n_runs > 0 for r in out.collect()) > 10
    assert P.digest(P.runs(docs.limit(0))).count() == 0


def test_collapsed_text_keeps_one_period(spark):
    docs = table(spark, [(1, "s " + "a b c " * 6 + "e"), (2, "p q " * 8 + "r " * 9), (3, "x y z")])
    out = {r.doc_id: r for r in P.runs(docs).collect()}
    assert out[1].collapsed == "s a b c e" and out[2].collapsed == "p q r" and out[3].collapsed == "x y z"
    assert [tuple(r) for r in out[2].runs] == [(0, 16, 2), (16, 9, 1)] and out[3].words == 3
