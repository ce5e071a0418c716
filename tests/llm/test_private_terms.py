"""Disclosing terms over whole documents against a brute-force count."""

from __future__ import annotations

import math
import random
import re

from daybook.llm import private
from tests.llm.test_operators import ODD, plain_private, table

RUN = re.compile(r"[^\W_]+")
HAN = "一-鿿"


def terms_of(text):
    """Surface terms with their places (whole runs; pairs of Chinese characters)."""
    out = [(m.group(), m.span()) for m in RUN.finditer(text)]
    return out, {text[i:i + 2] for i in range(len(text) - 1) if re.fullmatch(f"[{HAN}]{{2}}", text[i:i + 2])}


def entities_of(text):
    out = {}
    for x in filter(None, plain_private(text).split(",")):
        k, s, e = x.split(":")
        v = text[int(s):int(e)]
        out[(k, v.lower() if k in ("email", "ip") else re.sub("[^0-9]", "", v))] = None
    return list(out)


def brute(rows, disclosure=0.9, support=2):
    """Marked (start, end, generalise) of each row: runs only."""
    docs = [(entities_of(t or ""), {w.lower() for w, _ in terms_of(t or "")[0]} | terms_of(t or "")[1])
            for _, t in rows]
    levels = [ts | {t[:3] + "*" for t in ts} for _, ts in docs]
    n, n_t, n_e, n_te = len(rows), {}, {}, {}
    for (es, _), ls in zip(docs, levels):
        for t in ls:
            n_t[t] = n_t.get(t, 0) + 1
        for e in es:
            n_e[e] = n_e.get(e, 0) + 1
            for t in ls:
                n_te[e, t] = n_te.get((e, t), 0) + 1

    def tells(e, t):
        k = n_te.get((e, t), 0)
        ic = math.log2(n / n_e[e])
        return k >= support and ic > 0 and math.log2(k * n / (n_t[t] * n_e[e])) >= disclosure * ic
    out = []
    for (_, text), (es, _) in zip(rows, docs):
        text, marks = text or "", []
        base = [tuple(map(int, x.split(":")[1:])) for x in filter(None, plain_private(text).split(","))]
        for w, (s, e) in terms_of(text)[0]:
            told = [x for x in es if tells(x, w.lower())]
            if told and not any(s < b and a < e for a, b in base):
                marks.append((s, e, min(not tells(x, w.lower()[:3] + "*") for x in told)))
        out.append(marks)
    return out


def marked(spark, rows):
    out = {}
    for r in private.private_spans(private.plain(table(spark, rows))).collect():
        out.setdefault(r["_id"], []).append([(x.s, x.e, x.generalise) for x in r.term])
    return out


def test_terms_equal_a_brute_force_count(spark):
    rng = random.Random(3)
    vocab = [f"{a}{b}" for a in ("ab", "abc", "Zed", "q", "unit", "é") for b in ("", "1", "x", "yy", "77")]
    people = ["jo@acme.org", "Kim@x.io", "10.1.2.3", "+1 830 555 1234"]
    rows = []
    for i in range(160):
        words = [rng.choice(vocab) for _ in range(rng.randrange(0, 25))]
        for p in people:
            if rng.random() < 0.08:
                words.insert(rng.randrange(len(words) + 1), p)
                words += [f"friend{people.index(p)}"] * rng.randrange(2) + ["A" * people.index(p) + "z9"]
        rows.append((i, rng.choice([" ", ", ", " - "]).join(words)))
    rows += [(7000 + i, t) for i, (_, t) in enumerate(ODD)]
    got, want = marked(spark, rows), brute(rows)
    for (i, text), marks in zip(rows, want):
        assert got[i] == [marks], (i, text)
    assert sum(map(bool, want)) > 10


def test_far_short_and_alphanumeric_terms_are_marked(spark):
    filler = "plain words that many texts hold about mail writes and number " * 6
    rows = [(i, f"{filler} text {i % 9}") for i in range(80)]
    rows += [(100 + i, f"jane@corp.com {filler} Xylophonia Quimby of unit jd42, 王小明说") for i in range(3)]
    rows += [(200, "many words and 王国"), (201, "小明 and 说")]
    docs = private.plain(table(spark, rows))
    out = {r.doc_id: r for r in private.digest(private.private_spans(docs)).collect()}
    for i in range(100, 103):
        text = dict(rows)[i]
        spans = [x.split(":") for x in out[i].spans.split(",") if x.startswith("term")]
        words = {text[int(s):int(e)] for _, s, e in spans}
        assert {"Xylophonia", "Quimby", "jd42"} <= words and not words & {"mail", "about", "writes", "number"}
        assert any(w.startswith("王") for w in words)
        assert "jane" not in out[i].sanitised and "jd42" not in out[i].sanitised
        assert "Quimby" not in out[i].sanitised and "[email]" in out[i].sanitised
    assert out[5].sanitised is None and out[5].spans == ""


def test_repeated_rows_and_a_hot_entity(spark):
    rows = [(i, f"hot@all.org note{i % 3} rare{i}") for i in range(90)]
    rows += [(500, "same@x.org secretword")] * 3 + [(i, "other text") for i in range(600, 700)]
    got, want = marked(spark, rows), brute(rows)
    for (i, _), marks in zip(rows, want):
        assert got[i] == [marks] * len(got[i]) and len(got[i]) == sum(r[0] == i for r in rows)
    assert got[500][0]
