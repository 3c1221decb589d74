"""Personal data: pattern spans, and terms that give a protected value away.

Patterns find the base spans, and secrets beside them, in each text by built-in expressions alone: the pattern splits the text, and
the lengths of what lies between the matches give their places. The corpus then says which words disclose
a protected value. A word t that stands near a value e tells about it

    disclosure(t, e) = PMI(t; e) / IC(e),  PMI = log2(P(t, e) / (P(t) P(e))),  IC = -log2 P(e)

with probabilities over documents: 1 if t stands only in documents with e, 0 if the two are independent.
A term at or above the threshold, seen near e in enough different texts, is a span in every document that
holds e. Near are eight words on either side, up to the next value of the same kind. Sanitising replaces
base spans by their kind and terms by a general word.

Candidate terms are those near a value in enough texts; how many documents hold a word is counted, with
partial sums, before they are looked up. All work is projections, pre-aggregated counts and equi-joins.

Defined results: a null or empty text has no spans and the hash of the empty string; rows with a null or
repeated doc_id are each judged by their own text; copies of a text count once towards support; input
columns named like the results are replaced; words of one letter are no terms.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, bound, running, words

#: The patterns, in the order in which spans are listed. Possessive and anchored forms of
#: the plain ones, so a long run of letters or digits is walked once; the matches are the same.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?+[0-9]){15,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Further entities: key ids of a cloud service, and values given to a password, token or the like.
ENTITIES = PATTERNS | {
    "secret": r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[0-9A-Z]{16}(?![A-Za-z0-9])|(?i:password|passwd|secret|token|api[_-]?key)\x20?[=:]\x20?[^\x20\x09-\x0D]{8,}+",
}
KINDS = (*ENTITIES, "term")
#: Words on either side of a value that count as near it.
CONTEXT_WORDS = 8
MIN_TERM_CHARS = 2
#: Different texts in which a term must stand near a value.
MIN_SUPPORT = 3
DISCLOSURE = 0.9
#: More candidate terms than this are joined by a shuffle, fewer are sent to all executors.
BROADCAST_TERMS = 100_000
#: Texts with term spans and such spans, likewise; beyond it they are joined by a salted shuffle.
BROADCAST_TEXTS, BROADCAST_SPANS = 50_000, 500_000
SALTS = 16
_SPAN = "struct<kind:string,start:int,end:int,value:string>"
_LETTERS = r"\p{L}+"


class Check(NamedTuple):
    may: Callable[[Column], Column]
    holds: Callable[[Column], Column]


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(m: Column) -> Column:
    digits = F.split(F.reverse(_digits(m)), "")
    doubled = F.transform(
        F.filter(digits, lambda d: d != ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def _small(part: Column) -> Column:
    """Digits, leading zeros or not, that stand for 255 at most."""
    short = F.regexp_replace(part, "^0+", "")
    return (F.length(short) <= 3) & (F.concat(F.lit("0"), F.substring(short, 1, 3)).cast("int") <= 255)


CHECKS = {
    "email": Check(lambda t: F.contains(t, F.lit("@")), lambda m: F.lit(True)),
    "ip": Check(
        lambda t: t.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"),
        lambda m: F.forall(F.split(m, r"\."), _small),
    ),
    "card": Check(lambda t: t.rlike(r"[0-9](?:[\x20-]?+[0-9]){15}"), lambda m: F.length(_digits(m)).between(16, 19) & _luhn(m)),
    "phone": Check(lambda t: F.contains(t, F.lit("+")), lambda m: F.length(_digits(m)).between(8, 15)),
    "secret": Check(lambda t: t.rlike(r"A[KS]IA[0-9A-Z]|(?i:word|wd|secret|token|key)\x20?[=:]"), lambda m: F.lit(True)),
}


def placed(text: Column, pattern: str) -> Column:
    """Matches of the pattern in order, as (start, end, value), in code points, end exclusive."""

    def lengths(pairs: Column) -> Column:
        return F.transform(pairs, lambda x: F.length(x["between"]) + F.length(x["found"]))

    def spans(pairs: Column, ends: Column) -> Column:
        return F.zip_with(pairs, ends, lambda x, end: F.struct((end - F.length(x["found"])).alias("start"), end.alias("end"), x["found"].alias("value")))

    def with_found(found: Column) -> Column:
        between = F.slice(F.split(text, pattern, -1), 1, F.size(found))
        pairs = F.zip_with(between, found, lambda b, m: F.struct(b.alias("between"), m.alias("found")))
        return bound(pairs, lambda ps: bound(running(lengths(ps), lambda a, b: a + b), lambda ends: spans(ps, ends)))

    return bound(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), with_found)


def entity_spans(text: Column) -> Column:
    """Spans of entities by kind and start, base ones first, as array<struct<kind, start, end, value>>."""
    raw, none = F.coalesce(text, F.lit("")), F.array().cast(f"array<{_SPAN}>")

    def of(kind: str) -> Column:
        check = CHECKS[kind]
        good = F.filter(placed(raw, ENTITIES[kind]), lambda s: check.holds(s["value"]))
        return F.when(check.may(raw), _named(good, kind)).otherwise(none)

    return F.concat(*map(of, ENTITIES))


def _named(found: Column, kind: str) -> Column:
    return F.transform(
        found,
        lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")),
    )


def _protected(span: Column) -> Column:
    """A value without its spelling: lower case letters, digits of a number."""
    plain = F.when(span["kind"] == "email", F.lower(span["value"])).when(span["kind"].isin("ip", "secret"), span["value"]).otherwise(_digits(span["value"]))
    return F.concat(span["kind"], F.lit(":"), plain)


def _terms(text: Column) -> Column:
    return F.filter(F.regexp_extract_all(F.lower(text), F.lit(_LETTERS), F.lit(0)), lambda w: F.length(w) >= MIN_TERM_CHARS)


def _near(text: Column, spans: Column) -> Column:
    """(protected, terms near it) of all base spans."""

    def of(own: Column) -> Column:
        def one(s: Column, i: Column) -> Column:
            since = F.coalesce(F.get(own, i - 1)["end"], F.lit(0))
            until = F.coalesce(F.get(own, i + 1)["start"], F.length(text))
            left, right = words(F.substring(text, since + 1, s["start"] - since)), words(F.substring(text, s["end"] + 1, until - s["end"]))
            last = F.slice(left, F.greatest(F.size(left) - CONTEXT_WORDS, F.lit(0)) + 1, F.lit(CONTEXT_WORDS))
            near = F.concat_ws(" ", last, F.slice(right, 1, CONTEXT_WORDS))
            return F.struct(_protected(s).alias("protected"), F.array_distinct(_terms(near)).alias("near"))

        return F.transform(own, one)

    def own(kind: str) -> Column:
        return F.filter(spans, lambda s: s["kind"] == kind)

    return F.concat(*(bound(own(kind), of) for kind in ENTITIES))


def disclosing_terms(
    docs: DataFrame, spotted: DataFrame, min_support: int = MIN_SUPPORT, threshold: float = DISCLOSURE
) -> DataFrame:
    """(protected, term, disclosure) at or above the threshold; spotted: text, spans of documents with base spans."""
    near = spotted.select(F.xxhash64("text").alias("copy"), F.explode(_near(F.col("text"), F.col("spans"))).alias("s"))
    near = near.select("copy", F.col("s.protected").alias("protected"), F.explode("s.near").alias("term"))
    # Copies of a text are one row after the first, pre-aggregated step.
    support = near.distinct().groupBy("protected", "term").agg(F.count("*").alias("support")).filter(F.col("support") >= min_support)
    both = (
        spotted.select(F.col("row"), F.explode(F.array_distinct(F.transform("spans", _protected))).alias("protected"), F.array_distinct(_terms(F.col("text"))).alias("terms"))
    )
    candidates = support.select("protected", "term")
    value_docs = both.groupBy("protected").agg(F.count("*").alias("n_value"))
    pairs = both.join(candidates.groupBy("protected").agg(F.collect_set("term").alias("own")), "protected")
    joint = pairs.select("protected", F.explode(F.array_intersect("terms", "own")).alias("term")).groupBy("protected", "term").agg(F.count("*").alias("n_both"))
    wanted = candidates.select("term").distinct()
    few = wanted.limit(BROADCAST_TERMS + 1).count() <= BROADCAST_TERMS
    # A row for each word and task goes through the shuffle, whatever the candidates are.
    counted = docs.select(F.explode(F.array_distinct(_terms(F.col("text")))).alias("term")).groupBy("term").agg(F.count("*").alias("n_term"))
    n_term = counted.join(F.broadcast(wanted) if few else wanted, "term", "left_semi")
    total = docs.count()
    share = F.log2(F.col("n_both") * total / (F.col("n_term") * F.col("n_value"))) / F.log2(F.lit(total) / F.col("n_value"))
    found = joint.join(n_term, "term").join(value_docs, "protected")
    return found.withColumn("disclosure", F.when(F.col("n_value") < total, share).otherwise(F.lit(0.0))).filter(F.col("disclosure") >= threshold).select("protected", "term", "disclosure")


def find(docs: DataFrame, scratch: Scratch, min_support: int = MIN_SUPPORT, threshold: float = DISCLOSURE) -> DataFrame:
    """docs (doc_id, text, ...) with `spans`: base spans, then terms by start."""
    docs = docs.drop("spans", "row", "own", "term_spans")
    marked = docs.withColumn("spans", entity_spans(F.col("text")))
    holding = marked.filter(F.size("spans") > 0)
    # Documents with base spans, once: what follows reads them several times.
    spotted = scratch.table("spotted", holding.select(F.monotonically_increasing_id().alias("row"), "text", "spans"))
    told = scratch.table("terms", disclosing_terms(docs.select("text"), spotted, min_support, threshold))
    held = spotted.select("row", F.explode(F.array_distinct(F.transform("spans", _protected))).alias("protected"))
    # A row's text is what decides, so terms are looked up by it; copies have the same.
    own = held.join(told, "protected").groupBy("row").agg(F.collect_set("term").alias("own"))
    texts = spotted.join(own, "row").select("text", "spans", "own")
    named_words = F.filter(placed(F.col("text"), _LETTERS), lambda w: F.array_contains(F.col("own"), F.lower(w["value"])))
    free = F.filter(named_words, lambda w: ~F.exists(F.col("spans"), lambda s: (s["start"] < w["end"]) & (w["start"] < s["end"])))
    named = _named(free, "term")
    extra = texts.select(F.sha2("text", 256).alias("_key"), named.alias("term_spans")).groupBy("_key").agg(F.first("term_spans").alias("term_spans"))
    extra = scratch.table("extra", extra)
    size = extra.agg(F.count("*").alias("texts"), F.coalesce(F.sum(F.size("term_spans")), F.lit(0)).alias("spans")).first()
    if size["texts"] <= BROADCAST_TEXTS and size["spans"] <= BROADCAST_SPANS:
        out = marked.withColumn("_key", F.when(F.size("spans") > 0, F.sha2("text", 256)))
        out = out.join(F.broadcast(extra), "_key", "left").drop("_key")
    else:
        # Only rows with base spans move; copies of a text are spread by a salt.
        salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")
        salted = extra.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        held = holding.withColumns({"_key": F.sha2("text", 256), "_salt": salt}).join(salted, ["_key", "_salt"], "left").drop("_key", "_salt")
        out = held.unionByName(marked.filter(F.size("spans") == 0).withColumn("term_spans", F.lit(None).cast(f"array<{_SPAN}>")))
    return out.withColumn("spans", F.concat("spans", F.coalesce("term_spans", F.array().cast(f"array<{_SPAN}>")))).drop("term_spans")


def listed(spans: Column, kinds: tuple[str, ...] = KINDS) -> Column:
    """kind:start:end of the spans of these kinds, comma-joined."""
    own = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(own, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def sanitised(text: Column, spans: Column) -> Column:
    """The text with base spans replaced by their kind and terms generalised; spans that overlap are replaced as one, by what the first is."""
    raw = F.coalesce(text, F.lit(""))
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def replaced(own: Column, tops: Column) -> Column:
        # tops: the greatest end so far. A span that begins beyond those before it heads a group.
        before = lambda i: F.coalesce(F.get(tops, i - 1), F.lit(0))
        heads = F.filter(F.transform(own, lambda s, i: F.struct(s["start"].alias("start"), before(i).alias("since"), s["kind"].alias("kind"))), lambda h: h["start"] >= h["since"])
        label = lambda k: F.when(k == "term", F.lit("something")).otherwise(F.concat(F.lit("["), F.upper(k), F.lit("]")))
        parts = F.transform(heads, lambda h: F.concat(F.substring(raw, h["since"] + 1, h["start"] - h["since"]), label(h["kind"])))
        rest = F.substring(raw, before(F.size(own)) + 1, F.length(raw))
        return F.concat(F.array_join(parts, ""), rest)

    clean = bound(ordered, lambda own: bound(running(F.transform(own, lambda s: s["end"]), F.greatest), lambda tops: replaced(own, tops)))
    return F.when(F.size(spans) == 0, text).when(text.isNotNull(), clean)
