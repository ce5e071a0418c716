"""Test items in several blocks: the same results, and a bounded block at the driver."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from daybook.llm import decontaminate as D

SCHEMA = "doc_id long, text string, _key string, _spans int"  # names that clash with the operator's own


def windows(text, n=10):
    words = D.words_of(text)
    n = min(n, len(words))
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1 if n else 0)}


@pytest.mark.parametrize("n", [0, 1, 9, 10, 11, 19, 20, 21, 22, 31, 33, 200])
def test_slices_have_the_windows_of_the_item(n):
    text = " ".join(f"W{i}," for i in range(n))
    parts = list(D.slices_of(text, 10, size=20))
    assert all(len(p.split()) <= 20 for p in parts)
    assert set().union(*map(windows, parts)) == windows(text)


def made(spark):
    rng = random.Random(8)
    def words(n, of="abcdefgh"):
        return [rng.choice(of) * rng.randrange(1, 3) for _ in range(n)]
    items = [(i, " ".join(words(rng.randrange(8, 40)))) for i in range(10)] + [(None, "solo piece"), (11, None)]
    docs = []
    for i in range(40):
        w = words(rng.randrange(0, 60), "klmnop")
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(w) + 1)
            w[at:at] = (rng.choice(items[:11])[1]).split()
        docs.append((i, " ".join(w)))
    a = items[0][1].split()[:8]
    # only the cut brings the two halves of a short item together
    docs += [(90, "solo " + " ".join(items[1][1].split()) + " piece")]
    docs += [(91, " ".join(a)), (None, "solo piece"), (None, None), (92, ""), (0, docs[0][1]), (0, docs[0][1])]
    docs += [(93, " ".join(["k"] * 30_000 + items[2][1].split() + ["m"] * 30_000))]
    table = spark.createDataFrame([(*d, "x", 7) for d in docs], SCHEMA)
    return table, spark.createDataFrame(items, "item_id long, text string")


def rows(df):
    return sorted(map(str, df.collect()))


def test_blocks_give_what_one_block_gives(spark):
    docs, bench = made(spark)
    assert D.Items(bench, phrase_bytes=150).blocks > 3
    assert rows(D.decontaminate(docs, bench, phrase_bytes=150)) == rows(D.decontaminate(docs, bench))
    few, one = D.remove_windows(docs, bench, phrase_bytes=150), D.remove_windows(docs, bench)
    assert few.columns == one.columns == docs.columns and rows(few) == rows(one)
    assert D.decontaminate(few, bench).filter("contaminated").count() == 0
    assert "solo" not in few.filter("doc_id = 90").first().text
    # nothing to cut, no documents, no items
    clean = docs.filter("doc_id = 92 or text is null")
    assert rows(D.remove_windows(clean, bench, phrase_bytes=150)) == rows(clean)
    assert D.decontaminate(docs.limit(0), bench, phrase_bytes=150).count() == 0
    assert D.remove_windows(docs.limit(0), bench, phrase_bytes=150).count() == 0
    assert rows(D.remove_windows(docs, bench.limit(0))) == rows(docs)


def test_a_block_stays_as_large_while_the_benchmark_grows(spark):
    def largest(n, of_words):
        text = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(of_words)), lambda x: F.concat(
            F.lit("w"), (F.xxhash64(x, "id") % 997).cast("string"))), " ")
        items = D.Items(spark.range(n).select(F.col("id").alias("item_id"), text.alias("text")),
                        phrase_bytes=40_000)
        sizes = []
        for k in range(items.blocks):
            block = items.block(k)
            sizes.append(sum(len(w) for w, _ in block.value.by_length))
            block.destroy()
        return max(sizes)
    small = largest(400, 40)
    assert largest(4000, 40) < 1.5 * small
    # one item ten times as long as a block is dealt over blocks, too
    assert len(list(D.slices_of("w " * 60_000, 10, size=500))) > 100
