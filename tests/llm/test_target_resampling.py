"""Target resampling against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from daybook.llm import target_resampling as R
from tests.llm.test_operators import ODD, table

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def features(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    grams = [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return words, [zlib.crc32(g.encode()) % 10000 for g in grams]


def brute(rows, target):
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(features(text)[1])
    for text in target:
        t.update(features(text)[1])
    big_s, big_t = s.total() + 10000, t.total() + 10000
    gain = [math.floor(1000 * math.log((t[b] + 1) * big_s / ((s[b] + 1) * big_t))) for b in range(10000)]
    out = []
    for i, text in rows:
        words, found = features(text)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found)
        out.append([i, len(words), len(found), weight,
                    weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    long_enough = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = long_enough[: 5 * len(long_enough) // 100]
    ranks = {id(r): n + 1 for n, r in enumerate(drawn)}
    return [(r[0], r[2], r[3], r[4], ranks.get(id(r))) for r in out]


def random_rows(n, seed):
    rng = random.Random(seed)
    vocab = ["the", "a", "Ünï", "x" * 50, "42", "Zed", "ſ", "数据", "b2b"] + [f"w{i}" for i in range(60)]
    return [(i, "".join(rng.choice(vocab) + rng.choice([" ", ", ", "\n", "--", "\x7f", " [ "])
                        for _ in range(rng.randrange(0, 70)))) for i in range(n)]


def test_features_equal_plain_checksums(monkeypatch):
    texts = [t or "" for _, t in list(ODD) + random_rows(200, 1)] + ["tail", " lead", "a" * 4000 + " b c"]
    for window in (1 << 20, 300, 7):
        monkeypatch.setattr(R, "WINDOW", window)
        found = [Counter() for _ in texts]
        words = np.zeros(len(texts), dtype=np.int64)
        for buckets, text, w in R.text_features(texts):
            words += w
            for b, i in zip(buckets.tolist(), text.tolist()):
                found[i][b] += 1
        for i, t in enumerate(texts):
            want_words, want = features(t)
            assert words[i] == len(want_words) and found[i] == Counter(want), (window, i)


def test_rows_equal_brute_force(spark):
    rows = [r for r in ODD if r != (4, "one")] + random_rows(700, 2) + [(None, "null id " * 30)]
    target = [t for _, t in random_rows(30, 3)] + [None, ""]
    aim = spark.createDataFrame([(str(i), t) for i, t in enumerate(target)], "item_id string, text string")
    docs = table(spark, rows)
    got = sorted(map(tuple, R.digest(R.resample(docs, aim)).collect()), key=str)
    assert got == sorted(brute(rows, target), key=str)
    assert sum(r[4] is not None for r in got) > 20
    none = aim.limit(0)
    assert sorted(map(tuple, R.digest(R.resample(docs, none)).collect()), key=str) == sorted(
        brute(rows, []), key=str)
    assert R.resample(docs.limit(0), aim).count() == 0
    assert R.resample(docs.filter("doc_id < 5"), aim).filter("rank is not null").count() == 0


@pytest.mark.parametrize("values", [1, 7, 1 << 40])
def test_cutoff_is_exact_and_rounds_discard_a_quarter(spark, values):
    rng = random.Random(values)
    keys = sorted((rng.randrange(-values, values), rng.randrange(4), n) for n in range(5000))
    # partitions of very different sizes, sorted ones among them
    df = spark.createDataFrame(keys, "k0 long, k1 long, k2 long").repartitionByRange(5, F.col("k2") ** 2)
    df = df.unionByName(df.limit(0)).cache()
    for rank in (1, 1250, 4999):
        key, rounds = R.cutoff(df, rank, finish=3)
        assert key == keys[rank - 1]
        assert all(4 * b <= 3 * a + 4 for a, b in zip(rounds, rounds[1:])) and rounds[-1] <= 3
    assert R.cutoff(df, 0)[0] is None and R.cutoff(df, 5001)[0] is None


def test_ranks_follow_score_then_id(spark):
    rng = random.Random(8)
    rows = [(i, 30, rng.randrange(5)) for i in range(3000)] + [(None, 30, 4), (5, 30, 2), (9000, 3, 99)]
    scored = spark.createDataFrame(rows, "doc_id long, n_words long, score long").repartition(7)
    out = R.draw(scored, (40, 100), finish=10)
    drawn = sorted((r.rank, r.score, r.doc_id) for r in out.collect() if r.rank is not None)
    want = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[2], r[0] is None, r[0] or 0))
    want = want[: 40 * len(want) // 100]
    assert [(d[1], d[2]) for d in drawn] == [(r[2], r[0]) for r in want]
    assert [d[0] for d in drawn] == list(range(1, len(want) + 1)) and out.count() == len(rows)
