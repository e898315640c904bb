"""Personal data: patterns find entities, information theory finds what gives them away.

Masking an e-mail address is not enough if the words around it occur nowhere else. Over the
whole corpus, the co-occurrence of a term and an entity gives their pointwise mutual
information; its share of the entity's own information is how much the term discloses:

    PMI(e; t) = log(N n_te / (n_e n_t)),  IC(e) = log(N / n_e),
    disclosure = PMI / IC (1 - 2^-c)

with N documents, n_e of them with the entity, n_t with the term, n_te with both, in c different
contexts: the last factor smooths the estimate, so a coincidence of one context stays at a half.
Most entities stand in one document only; for them the evidence is that of what they belong to:
mail domain, IP network, card issuer, block of phone numbers. Terms anywhere in a document with
an entity that disclose ``GENERALISE`` of it or more are generalised, from ``REMOVE`` on they
are removed. All of it is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fathom.llm.common import bind, join_keys, materialize, row_key, table

#: Kinds in the order in which spans are listed; ``term`` spans are the method's.
KINDS = ("email", "ip", "card", "phone")
TERM = "term"

#: The contract's patterns, written so that Java's matcher neither recurses (possessive groups)
#: nor starts anew inside a run that has failed (a match begins a run, or where the last ended).
_LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_MARK = {"email": "@", "phone": "+"}

#: Characters on either side of an entity that are its context, and what a term is: a word of
#: three letters or more that stands alone but for punctuation (so never part of an address).
REACH = 80
_TERM = r"""(?<![^\s("'\[])\p{L}{3,}(?=[.,;:!?)"'\]]*(?:\s|$))"""

#: Different contexts in which a term must stand with an entity, and the disclosure from which
#: it is generalised or removed.
LEAST_CONTEXTS = 1
GENERALISE, REMOVE = 0.7, 0.95

_BLOCK = 64


def _running(sizes: Column) -> Column:
    """Sum of the entries before each entry, in blocks: no entry walks the whole array."""

    def within(array: Column, low: Column, n: Column) -> Column:
        return F.aggregate(F.slice(array, low + 1, n), F.lit(0).cast("bigint"), lambda a, x: a + x)

    def sums(sizes: Column) -> Column:
        last = F.floor((F.size(sizes) - 1) / _BLOCK).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), last), lambda b: within(sizes, b * _BLOCK, F.lit(_BLOCK)))
        zero = F.array(F.lit(0).cast("bigint"))
        before = F.aggregate(blocks, zero, lambda a, x: F.array_append(a, F.element_at(a, -1) + x))

        def starts(before: Column) -> Column:
            return F.transform(
                sizes,
                lambda _, i: F.get(before, F.floor(i / _BLOCK).cast("int"))
                + within(sizes, (F.floor(i / _BLOCK) * _BLOCK).cast("int"), (i % _BLOCK).cast("int")),
            )

        return bind(before, starts)

    return bind(sizes, sums)


def _placed(text: Column, pattern: str, entry) -> Column:
    """``entry(start, value, gap before, gap after)`` of each match of ``pattern``.

    Spark has no function for the places of all matches; the text between them has lengths too.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def places(values: Column) -> Column:
        gaps = F.split(text, pattern, -1)

        def of(gaps: Column) -> Column:
            sizes = F.transform(values, lambda v, i: (F.length(v) + F.length(F.get(gaps, i))).cast("bigint"))
            return bind(
                _running(sizes),
                lambda at: F.transform(
                    values,
                    lambda v, i: entry(F.get(at, i) + F.length(F.get(gaps, i)), v, F.get(gaps, i), F.get(gaps, i + 1)),
                ),
            )

        return F.when(F.size(values) > 0, bind(gaps, of))

    return bind(found, places)


def _passes(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return value.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    if kind == "card":
        return F.length(digits).between(16, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def _entities(text: Column, kind: str) -> Column:
    """Matches of ``kind`` that pass: start, stop, value and the text on either side."""
    spans = _placed(
        text, PATTERNS[kind],
        lambda start, v, before, after: F.struct(
            start.alias("start"), (start + F.length(v)).alias("stop"), v.alias("value"),
            F.right(before, F.lit(REACH)).alias("before"), F.left(after, F.lit(REACH)).alias("after"),
        ),
    )
    kept = F.filter(spans, lambda s: _passes(kind, s["value"]))
    mark = _MARK.get(kind)
    return F.when(F.contains(text, F.lit(mark)), kept) if mark else kept


def entities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, key, text`` and, by kind, the entities of each row; null where there is none."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("key", row_key("doc_id", "text"))
    return rows.withColumns({kind: _entities(F.coalesce("text", F.lit("")), kind) for kind in KINDS})


def _group(kind: str, value: Column) -> Column:
    """What an entity belongs to: mail domain, IP network (/16), card issuer, phone block."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "email":
        return F.lower(F.substring_index(value, "@", -1))
    if kind == "ip":
        return F.substring_index(value, ".", 2)
    if kind == "card":
        return F.left(digits, F.lit(6))
    return F.left(digits, F.length(digits) - 4)


def _contexts(once: DataFrame) -> DataFrame:
    """``key, entity, context, n``: entities and their groups, one context of each a row of ``once``."""
    context = lambda s: F.xxhash64(s["before"], s["after"])

    def named(kind: str) -> Column:
        def both(s: Column) -> Column:
            names = (("", s["value"]), ("*", _group(kind, s["value"])))
            return F.array(*(F.struct(F.concat(F.lit(f"{kind}{m}:"), v).alias("entity"), context(s).alias("context")) for m, v in names))

        return F.flatten(F.transform(kind, both))

    none = F.array().cast("array<struct<entity:string,context:bigint>>")
    each = F.concat(*(F.coalesce(named(kind), none) for kind in KINDS))
    return once.select("key", "n", F.explode(each).alias("e")).groupBy("key", "e.entity", "n").agg(F.min("e.context").alias("context"))


def _words(text: Column) -> Column:
    """The terms of a text: term, start, stop."""
    return _placed(
        text, _TERM,
        lambda at, v, before, after: F.struct(
            F.lower(v).alias("term"), at.alias("start"), (at + F.length(v)).alias("stop")
        ),
    )


def disclosing_terms(
    docs: DataFrame, held: DataFrame, words: DataFrame, least_contexts: int = LEAST_CONTEXTS,
    threshold: float = GENERALISE,
) -> DataFrame:
    """``term, entity, disclosure`` of the terms that disclose ``threshold`` or more.

    Frequencies are of all documents. Pairs are counted map-side first, so an entity or term
    that is everywhere is a few rows of each task. PMI is never above IC, so disclosure is at
    most the smoothing factor: entities and pairs in too few contexts to reach ``threshold``
    are left out before anything is counted, without loss.
    """
    n_docs = max(1, docs.count())
    least = max(1, least_contexts)
    while 1 - 2.0**-least < min(threshold, 1 - 2.0**-50):
        least += 1
    of_entity = held.groupBy("entity", "context").agg(F.sum("n").alias("n"))
    of_entity = of_entity.groupBy("entity").agg(F.sum("n").alias("n_e"), F.count(F.lit(1)).alias("contexts"))
    of_entity = materialize(of_entity.filter(F.col("contexts") >= least).select("entity", "n_e"))
    often = join_keys(held, of_entity.select("entity"), "entity", "left_semi")
    often = often.groupBy("key").agg(F.collect_list(F.struct("entity", "context", "n")).alias("e"))
    # One row a document until terms and entities are written out together.
    terms = F.array_distinct(F.transform("words", lambda w: w["term"]))
    together = words.join(often, "key").select("e", F.explode(terms).alias("term"))
    together = together.select("term", F.inline("e")).groupBy("term", "entity", "context").agg(F.sum("n").alias("n"))
    together = together.groupBy("term", "entity").agg(F.sum("n").alias("n_te"), F.count(F.lit(1)).alias("contexts"))
    together = materialize(together.filter(F.col("contexts") >= least))
    wanted = materialize(together.select("term").distinct())
    found = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(_TERM), F.lit(0)))
    # Counted in each task before anything is joined: the rows of a word are never brought together.
    of_term = docs.select(F.explode(found).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_t"))
    # An inner join: a semi-join would be pushed below the count.
    of_term = join_keys(of_term, wanted, "term", "inner")
    counted = together.join(of_term, "term").join(of_entity, "entity")
    own = F.log(n_docs / F.col("n_e"))
    # Lower case of a word alone can differ from that of the text around it.
    pmi = F.log(F.col("n_te") * n_docs / (F.col("n_e") * F.greatest("n_t", "n_te")))
    disclosure = F.when(own > 0, pmi / own * (1 - F.pow(F.lit(2.0), -F.col("contexts")))).otherwise(0.0)
    return counted.select("term", "entity", disclosure.alias("disclosure")).filter(F.col("disclosure") >= threshold)


SPAN = "struct<kind:string,start:bigint,stop:bigint,act:string>"


def personal_data(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_contexts: int = LEAST_CONTEXTS,
    generalise: float = GENERALISE, remove: float = REMOVE,
) -> DataFrame:
    """``doc_id, key, spans`` for each row of ``docs``: kind, start, stop (code points), act.

    Entities are listed by kind, then start, and their act is ``mask``; ``term`` spans follow,
    to be generalised or removed. Null and empty texts have none; rows equal in id and text
    share a ``key`` and their result; an empty table gives no rows; other columns are not read.
    """
    source = entities(docs, id_col, text_col)
    any_of = F.greatest(*(F.coalesce(F.size(k), F.lit(0)) for k in KINDS)) > 0
    found = materialize(source.select("doc_id", "key", *KINDS, F.when(any_of, F.col("text")).alias("text")))
    once = found.filter(F.col("text").isNotNull()).groupBy("key").agg(
        F.first(F.struct("text", *KINDS)).alias("r"), F.count(F.lit(1)).alias("n")
    )
    once = materialize(once.select("key", "n", "r.*"))
    held = materialize(_contexts(once))
    words = materialize(once.select("key", _words(F.col("text")).alias("words")))
    strong = materialize(disclosing_terms(source.select("text"), held, words, least_contexts, generalise))
    act = F.when(F.max("disclosure") >= remove, "remove").otherwise("generalise")
    hit = join_keys(words.select("key", F.inline("words")), strong, "term", "inner")
    hit = hit.join(held.select("key", "entity"), ["key", "entity"]).groupBy("key", "start", "stop").agg(act.alias("act"))
    by_key = materialize(
        hit.groupBy("key").agg(
            F.array_sort(F.collect_list(F.struct(F.lit(TERM).alias("kind"), "start", "stop", "act"))).alias("terms")
        )
    )
    none = F.array().cast(f"array<{SPAN}>")
    parts = [F.coalesce(_masks(kind), none) for kind in KINDS]
    return found.join(by_key, "key", "left").select(
        "doc_id", "key", F.concat(*parts, F.coalesce("terms", none)).alias("spans")
    )


def _masks(kind: str) -> Column:
    return F.transform(
        kind, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"), F.lit("mask").alias("act"))
    )


def sanitised(text: Column, spans: Column) -> Column:
    """``text`` with entities masked, and terms generalised or removed; of overlapping spans the first."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind"), s["act"].alias("act"))))
    zero = F.array().cast("array<struct<start:bigint,stop:bigint,kind:string,act:string>>")
    apart = F.aggregate(
        ordered, zero,
        lambda a, s: F.when((F.size(a) == 0) | (s["start"] >= F.get(a, F.size(a) - 1)["stop"]), F.array_append(a, s)).otherwise(a),
    )

    def build(cuts: Column) -> Column:
        def piece(s: Column, i: Column) -> Column:
            low = F.coalesce(F.get(cuts, i - 1)["stop"], F.lit(0))
            put = F.when(s["act"] == "remove", "").otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
            return F.concat(F.substring(text, (low + 1).cast("int"), (s["start"] - low).cast("int")), put)

        end = F.coalesce(F.get(cuts, F.size(cuts) - 1)["stop"], F.lit(0))
        rest = F.substring(text, (end + 1).cast("int"), F.length(text))
        return F.concat(F.array_join(F.transform(cuts, piece), ""), rest)

    return bind(apart, build)


def sanitise(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text and others) with sanitised texts; ``n_chars``, if there, follows.

    Only rows with spans meet them; the others pass as they are.
    """
    name = "__row_key"
    spans = materialize(found.filter(F.size("spans") > 0).dropDuplicates(["key"]).select(F.col("key").alias(name), F.col("spans").alias("__spans")))
    rows = docs.withColumn(name, row_key("doc_id", "text"))
    keys = spans.select(name)
    clean = join_keys(rows, keys, name, "left_anti")
    cleaned = join_keys(rows, keys, name, "left_semi").join(spans, name)
    cleaned = cleaned.withColumn("text", sanitised(F.col("text"), F.col("__spans")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        cleaned = cleaned.withColumn("n_chars", F.length("text").cast(kind))
    return clean.unionByName(cleaned.drop("__spans")).drop(name)


def digest(found: DataFrame) -> DataFrame:
    """Counts per base kind, a checksum of the base spans, and all spans as text."""

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")

    base = F.filter("spans", lambda s: s["kind"] != TERM)
    return found.select(
        "doc_id", *[count(kind) for kind in KINDS], F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(personal_data(table(spark, sf_dir, "documents")))
