"""Personal data: information-theoretic sanitisation, in DataFrame functions.

Patterns find the protected entities (addresses, numbers). What then still
gives an entity away are the words of its documents: if a word occurs in few documents
but with the entity, it reveals it. From the corpus, for a term t and an entity e,

    pointwise mutual information  PMI(t; e) = log2(n(t, e) * N / (n(t) * n(e)))
    information of the entity     IC(e)     = log2(N / n(e))

with n counting documents (rows), N all of them, and n(t, e) those that hold both,
anywhere. A term discloses an entity when
PMI reaches ``DISCLOSURE`` of IC in at least ``SUPPORT`` documents. Such terms
are generalised to the class of terms with their first letters, if the class
stays below the threshold, and removed otherwise.

Terms are all runs of letters, marks and digits, of any length, lower-cased; in
Chinese and Japanese script, which has no spaces, also all pairs of neighbouring
characters. Every occurrence of a disclosing term is marked in the documents that
hold its entity (of overlapping pairs the leftmost), but for those inside an entity
that is replaced anyway; documents without an entity stay as they are. Pairs of entity
and term are counted once for each document and added up before the shuffle, so an
entity or a word may be in any share of the documents.

Kinds (fixed patterns): ``email``, ``ip``, ``card``, ``phone``; terms are added
as ``term``.

Defined results: NULL texts are empty and hold nothing; an entity in every
document has no information to disclose; repeated rows count as documents of
their own and get equal results; texts are read whole; ties can't arise; an
empty table gives no rows. Other columns may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import stored

#: Share of an entity's information that a term may not reveal.
DISCLOSURE = 0.9
#: Documents in which a term must occur with the entity.
SUPPORT = 2
#: Letters of a term's class.
CLASS_LETTERS = 3
#: Fixed number of hash buckets that say which terms are counted at all.
TERM_BUCKETS = 1 << 16

# The kinds and their patterns. Each finds the leftmost
# non-overlapping matches of the plain pattern; look-behinds only keep the
# search from trying the inside of a run whose beginning has failed, and
# possessive quantifiers from trying shorter runs that can't match either.
EMAIL = (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IP_VALID = (r"^0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
            r"(?:\.0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])){3}$")
TERM = r"[\p{L}\p{M}\p{N}]+"
UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}]"
PAIR = rf"(?=({UNSPACED}{{2}}))"
#: Copies of the told pairs, over which the rows of one frequent pair are dealt.
SALTS = 16

_FOUND = "array<struct<s:int,e:int,v:string>>"


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether the digits of the text pass the Luhn check."""
    digits = F.split(F.reverse(_digits(number)), "")
    worth = F.transform(digits, lambda d, i: F.when(d == "", 0).otherwise(
        F.when(i % 2 == 0, d.cast("int")).otherwise(
            (d.cast("int") * 2) - F.when(d.cast("int") > 4, 9).otherwise(0))))
    return F.aggregate(worth, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


KINDS: list[tuple[str, str, object, object]] = [
    # kind, pattern, what the text must hold for it, what a match must hold
    ("email", EMAIL, lambda t: F.contains(t, F.lit("@")), lambda v: F.lit(True)),
    ("ip", IP, lambda t: F.contains(t, F.lit(".")), lambda v: F.rlike(v, F.lit(IP_VALID))),
    ("card", CARD, lambda t: F.lit(True), luhn),
    ("phone", PHONE, lambda t: F.contains(t, F.lit("+")),
     lambda v: F.length(_digits(v)).between(8, 15)),
]


def _hits(text: Column, pattern: str, when: Column) -> Column:
    return F.when(when, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(
        F.array().cast("array<string>"))


def _pieces(text: Column, pattern: str, hits: Column) -> Column:
    """The text between the matches."""
    return F.when(F.size(hits) > 0, F.split(text, pattern, -1)).otherwise(
        F.array().cast("array<string>"))


def _located(hits: Column, pieces: Column) -> Column:
    """Start, end and match."""
    n = F.size(hits)
    both = F.arrays_zip(F.slice(pieces, 1, n).alias("p"), hits.alias("h"))

    def step(acc: Column, x: Column) -> Column:
        s = acc["at"] + F.length(x["p"])
        e = s + F.length(x["h"])
        one = F.struct(s.alias("s"), e.alias("e"), x["h"].alias("v"))
        return F.struct(e.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    zero = F.struct(F.lit(0).alias("at"), F.array().cast(_FOUND).alias("out"))
    return F.when(n > 0, F.aggregate(both, zero, step, lambda a: a["out"])).otherwise(
        F.array().cast(_FOUND))


def find_entities(docs: DataFrame) -> DataFrame:
    """_id, _hash (of the text), an array of matches for each kind, and _held, the
    text of a document that holds any (NULL otherwise)."""
    text = F.col("_text")
    out = docs.select("_id", "_text", F.xxhash64("_text").alias("_hash"),
                      *[_hits(text, p, when(text)).alias(f"_{k}_h") for k, p, when, _ in KINDS])
    out = out.select("_id", "_text", "_hash", *[f"_{k}_h" for k, *_ in KINDS],
                     *[_pieces(text, p, F.col(f"_{k}_h")).alias(f"_{k}_p") for k, p, *_ in KINDS])
    located = out.select("_id", "_text", "_hash", *[
        _located(F.col(f"_{k}_h"), F.col(f"_{k}_p")).alias(k) for k, *_ in KINDS])
    kinds = located.select("_id", "_text", "_hash", *[_valid(k, ok).alias(k) for k, _, _, ok in KINDS])
    any_ = sum((F.size(k) for k, *_ in KINDS), F.lit(0)) > 0
    return kinds.select("_id", "_hash", *[k for k, *_ in KINDS], F.when(any_, F.col("_text")).alias("_held"))


def _valid(kind: str, ok) -> Column:
    return F.filter(kind, lambda x: ok(x["v"]))


def _entities() -> Column:
    """The names of a document's entities, each once."""
    def named(kind: str) -> Column:
        return F.transform(kind, lambda x: F.concat(
            F.lit(kind + ":"), F.lower(x["v"]) if kind in ("email", "ip") else _digits(x["v"])))
    return F.array_distinct(F.concat(*[named(k) for k, *_ in KINDS]))


def words(text: Column) -> Column:
    """The different terms of a text, as they are written."""
    pairs = F.when(F.rlike(text, F.lit(UNSPACED)),
                   F.array_distinct(F.regexp_extract_all(text, F.lit(PAIR), F.lit(1)))).otherwise(
        F.array().cast("array<string>"))
    return F.array_union(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), pairs)


def document_terms(found: DataFrame) -> DataFrame:
    """_id, _hash, entity, word: every entity of a document with every term of it."""
    each = found.filter(F.col("_held").isNotNull()).select(
        "_id", "_hash", _entities().alias("_es"), words(F.col("_held")).alias("_ws"))
    return each.select("_id", "_hash", "_ws", F.explode("_es").alias("entity")).select(
        "_id", "_hash", "entity", F.explode("_ws").alias("word"))


def _class(term: Column) -> Column:
    return F.concat(F.substring(term, 1, CLASS_LETTERS), F.lit("*"))


def term_counts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """term, n_t: in how many documents each term (or class of terms, with a
    star) of ``wanted`` occurs. All documents are counted; a table of at most
    ``TERM_BUCKETS`` hash buckets keeps most other words out of the shuffle."""
    bucket = F.pmod(F.xxhash64("term"), F.lit(TERM_BUCKETS).cast("long"))
    marked = wanted.select(bucket.alias("_bucket")).distinct()
    terms = F.array_distinct(F.transform(words(F.col("_text")), F.lower))
    terms = F.array_union(terms, F.transform(terms, _class))
    return (docs.select(F.explode(terms).alias("term")).withColumn("_bucket", bucket)
            .join(F.broadcast(marked), "_bucket", "left_semi")
            .groupBy("term").agg(F.count(F.lit(1)).alias("n_t"))
            .join(wanted.select("term").distinct(), "term"))


def disclosing(docs: DataFrame, found: DataFrame, n_docs: int,
               disclosure: float = DISCLOSURE, support: int = SUPPORT) -> DataFrame:
    """entity, term, generalise: the terms that disclose an entity and whether
    their class is general enough."""
    terms = F.array_distinct(F.transform(words(F.col("_held")), F.lower))
    each = found.filter(F.col("_held").isNotNull()).select(_entities().alias("_es"), terms.alias("_ts"))
    # a document counts once for an entity and a term or class
    level = F.array_union("_ts", F.transform("_ts", _class))
    pairs = (each.select(F.explode("_es").alias("entity"), level.alias("_ts"))
             .select("entity", F.explode("_ts").alias("term"))
             .groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_te")))
    entities = (each.select(F.explode("_es").alias("entity"))
                .groupBy("entity").agg(F.count(F.lit(1)).alias("n_e")))
    pairs = stored(pairs.filter(F.col("n_te") >= support).join(entities, "entity"))
    counts = term_counts(docs, pairs)
    n = F.lit(float(n_docs))
    pmi = F.log2(F.col("n_te") * n / (F.col("n_t") * F.col("n_e")))
    ic = F.log2(n / F.col("n_e"))
    judged = pairs.join(counts, "term").select(
        "entity", "term", ((ic > 0) & (pmi >= disclosure * ic)).alias("_tells"))
    # few rows, used twice: the count over all documents runs once
    told = stored(judged.filter("_tells").select("entity", "term"))
    classes = told.filter(F.endswith("term", F.lit("*"))).select(
        "entity", F.col("term").alias("_class"))
    terms = told.filter(~F.endswith("term", F.lit("*"))).withColumn("_class", _class(F.col("term")))
    return terms.join(classes.withColumn("_too", F.lit(True)), ["entity", "_class"], "left").select(
        "entity", "term", F.col("_too").isNull().alias("generalise"))


def _joined(kind: str, spans: Column) -> Column:
    return F.transform(spans, lambda x: F.concat_ws(":", F.lit(kind), x["s"], x["e"]))


def private_spans(docs: DataFrame, disclosure: float = DISCLOSURE,
                  support: int = SUPPORT) -> DataFrame:
    """For every row of ``docs`` (_id, _text): _id, _hash, the kinds' matches
    and ``term``, the disclosing terms (s, e, generalise), by start."""
    found = stored(find_entities(docs))
    n_docs = found.count()
    tells = stored(disclosing(docs, found, n_docs, disclosure, support))
    # the told terms of each document; repeated rows have equal ones. One pair may be in
    # any share of the rows, so they are dealt over SALTS copies of it.
    told = tells.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    held = (document_terms(found).withColumn("term", F.lower("word"))
            .withColumn("_salt", F.pmod(F.xxhash64("_id", "_hash"), F.lit(SALTS)).cast("int")))
    terms = (held.join(told, ["entity", "term", "_salt"])
             .groupBy("_id", "_hash", "word").agg(F.min("generalise").alias("generalise"))
             .groupBy(F.col("_id").alias("_tid"), F.col("_hash").alias("_thash"))
             .agg(F.map_from_entries(F.collect_list(F.struct("word", "generalise"))).alias("_told")))
    out = found.join(terms, found["_id"].eqNullSafe(terms["_tid"])
                     & (found["_hash"] == terms["_thash"]), "left")
    out = out.withColumn("_pattern", _pattern(F.map_keys("_told")))
    out = out.withColumn("_hits", F.when(F.col("_told").isNotNull(), F.regexp_extract_all(
        F.col("_held"), F.col("_pattern"), F.lit(0))))
    pieces = F.when(F.size("_hits") > 0, F.split(F.col("_held"), F.col("_pattern"), F.lit(-1)))
    out = out.withColumn("_pieces", pieces).withColumn("term", F.when(
        F.size("_hits") > 0, F.transform(_located(F.col("_hits"), F.col("_pieces")), lambda x: F.struct(
            x["s"].alias("s"), x["e"].alias("e"),
            F.element_at("_told", x["v"]).alias("generalise")))))
    base = F.concat(*[F.transform(k, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e")))
                      for k, *_ in KINDS])
    free = F.filter("term", lambda t: ~F.exists(base, lambda b: (b["s"] < t["e"]) & (t["s"] < b["e"])))
    none = F.array().cast("array<struct<s:int,e:int,generalise:boolean>>")
    return out.select("_id", "_hash", "_held", *[k for k, *_ in KINDS],
                      F.coalesce(free, none).alias("term"))


def _pattern(terms: Column) -> Column:
    """One pattern for the occurrences of a document's terms (letters, marks and
    digits only, so nothing needs quoting): whole runs, or pairs of unspaced
    characters anywhere. Longer ones first."""
    pair = (lambda t: F.rlike(t, F.lit(f"^{UNSPACED}{{2}}$")))
    longest = F.transform(F.array_sort(F.transform(terms, lambda t: F.struct(
        -F.length(t).alias("n"), t.alias("t")))), lambda x: x["t"])
    whole, pairs = F.filter(longest, lambda t: ~pair(t)), F.filter(longest, pair)
    run = TERM[:-1]
    return F.concat_ws("|", F.when(F.size(whole) > 0, F.concat(
        F.lit(f"(?<!{run})(?:"), F.array_join(whole, "|"), F.lit(f")(?!{run})"))),
        F.when(F.size(pairs) > 0, F.array_join(pairs, "|")))


def digest(spans: DataFrame) -> DataFrame:
    """doc_id, counts, base_sha256 and spans of every document, and its sanitised
    text where something is replaced (NULL otherwise)."""
    base = F.concat(*[_joined(k, F.col(k)) for k, *_ in KINDS])
    return spans.select(
        F.col("_id").alias("doc_id"),
        *[F.size(k).cast("long").alias(f"n_{k}") for k, *_ in KINDS],
        F.sha2(F.array_join(base, ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.concat(base, _joined("term", F.col("term"))), ",").alias("spans"),
        F.size("term").cast("long").alias("n_term"),
        F.size(F.filter("term", lambda t: t["generalise"])).cast("long").alias("n_generalised"),
        F.when(F.size(_cuts()) > 0, _put(F.col("_held"), _cuts())).alias("sanitised"))


def _replaced(kind: str) -> Column:
    return F.transform(kind, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"),
                                                F.lit(f"[{kind}]").alias("by")))


def _cuts() -> Column:
    """What is replaced by what, by start."""
    return F.array_sort(F.concat(
        *[_replaced(k) for k, *_ in KINDS],
        F.transform("term", lambda t: F.struct(t["s"].alias("s"), t["e"].alias("e"),
                                               F.when(t["generalise"], "*").otherwise("[...]")
                                               .alias("by")))))


def _put(text: Column, cuts: Column) -> Column:
    """The text with its cuts replaced; what overlaps an earlier one goes with it."""
    def put(acc: Column, x: Column) -> Column:
        kept = F.substring(text, acc["at"] + 1, F.greatest(x["s"] - acc["at"], F.lit(0)))
        by = F.when(x["by"] == "*", F.concat(F.substring(text, x["s"] + 1, F.lit(CLASS_LETTERS)),
                                             F.lit("*"))).otherwise(x["by"])
        inside = x["s"] < acc["at"]  # overlaps what has been replaced
        return F.struct(F.greatest(acc["at"], x["e"]).alias("at"),
                        F.when(inside, acc["out"]).otherwise(F.concat(acc["out"], kept, by)).alias("out"))

    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    return F.aggregate(cuts, zero, put, lambda a: F.concat(
        a["out"], F.substring(text, a["at"] + 1, F.length(text))))


def sanitise(docs: DataFrame) -> DataFrame:
    """_id and the text with entities replaced by their kind ("[email]"),
    disclosing terms by their class ("abc*") or by "[...]"."""
    changed = private_spans(docs).filter(F.col("_held").isNotNull()).select(
        F.col("_id").alias("_sid"), F.col("_hash").alias("_shash"),
        _put(F.col("_held"), _cuts()).alias("_new")).distinct()
    texts = docs.withColumn("_hash", F.xxhash64("_text"))
    both = texts.join(changed, texts["_id"].eqNullSafe(changed["_sid"])
                      & (texts["_hash"] == changed["_shash"]), "left")
    return both.select("_id", F.coalesce("_new", "_text").alias("text"))


def plain(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """_id and _text (NULL texts are empty): nothing here runs Python on the
    executors, so no source is sent to them."""
    return docs.select(F.col(id_col).cast("long").alias("_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
