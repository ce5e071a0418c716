"""Bucket counts, log ratios and weights of the quality sampling against plain Python."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest

from daybook.llm import quality
from daybook.llm.common import id_text
from daybook.llm.jaccard import WordHashes


def grams(text):
    """Bucket numbers by whole-number arithmetic, a word and a pair at a time."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    hashes, mask = WordHashes(), (1 << 64) - 1
    h = [int(hashes[w]) for w in words]
    values = h + [(a * int(quality._PAIR) + b * 3) & mask for a, b in zip(h, h[1:])]
    def mixed(x):
        x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & mask
        x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & mask
        return x ^ (x >> 31)
    return [mixed(v) >> (64 - quality.BITS) for v in values]


def made(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("abcdefghij") for _ in range(rng.randrange(0, 30)))) for i in range(80)]
    rows += [(80, None), (81, ""), (82, " \t\n"), (83, "Één ÜBER straße 東京"), (None, "a b c"), (None, None),
             (5, rows[5][1]), (5, rows[5][1]), (84, "a b " * 5000)]
    labels = [(i, i % 2, 0) for i in range(60)] + [(3, 1, 0), (None, 1, 0), (7, None, 0), (999, 1, 0)]
    return (rows, labels, spark.createDataFrame([(*r, 1.5) for r in rows], "doc_id long, text string, key double"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_counts_ratio_and_weights_equal_brute_force(spark):
    rows, labels, docs, _ = made(spark)
    counted = Counter(b for _, t in rows for b in grams(t))
    got = quality.bucket_counts(id_text(docs).repartition(5))
    assert {int(i): int(n) for i, n in enumerate(got) if n} == dict(counted)

    good = {i for i, y, _ in labels if y == 1 and i is not None}
    target = np.zeros(1 << quality.BITS, dtype=np.int64)
    for i, t in rows:
        if i in good:
            for b in grams(t):
                target[b] += 1
    ratio = quality.log_ratio(target, got)
    t_all, r_all = target.sum() + len(target), got.sum() + len(got)
    expected = {b: math.log((target[b] + 1) / t_all) - math.log((got[b] + 1) / r_all) for b in counted}
    assert all(abs(ratio[b] - x) < 1e-9 for b, x in expected.items())
    weights = quality.weighted(docs, ratio).collect()
    want = sorted((str(i), round(sum(expected[b] for b in grams(t)), 6)) for i, t in rows)
    assert [(i, pytest.approx(w, abs=1e-4)) for i, w in want] == sorted(
        (str(r.doc_id), r.log_weight) for r in weights)


def test_sample_takes_the_largest_keys_with_null_ids_and_ties(spark):
    rows, labels, docs, labelled = made(spark)
    out = quality.resample(docs, labelled).collect()
    known = [(i, y) for i, y, _ in labels if i is not None and y is not None]
    share = sum(y for _, y in known) / len(known)
    assert len(out) == round(share * len(rows))
    everything = quality.resample(docs, labelled.filter("quality = 1")).collect()  # share 1: every row
    assert len(everything) == len(rows)
    target = [t for i, t in rows if i in {i for i, y in known if y == 1}]
    ratio = quality.log_ratio(
        np.bincount([b for t in target for b in grams(t)], minlength=1 << quality.BITS),
        np.bincount([b for _, t in rows for b in grams(t)], minlength=1 << quality.BITS))
    keyed = quality.weighted(docs, ratio).withColumn(
        "key", quality.F.col("log_weight") + quality.gumbel("doc_id")).collect()
    best = sorted(keyed, key=lambda r: (-r.key, r.doc_id is None, r.doc_id or 0))[:len(out)]
    assert sorted(str(r.doc_id) for r in out) == sorted(str(r.doc_id) for r in best)
