"""Quality rules: a threshold table compiled into one Spark projection.

``verdict`` is one expression: the counts, the ratios and the boolean that ``compile_rules`` makes of the
table, as a struct in which each part is made once and bound to a variable. ``judge`` lays its fields out
by a generator of one row, so a filter on them stays above it and copies nothing. Everything is built-in
expressions on one row; nothing is shuffled, so a hot source or a long document costs its own text only.

Defined results: a null or empty text has no words and all counts 0, and is rejected; ``doc_id`` may be
null or repeated, every row is judged alone; extra columns stay, but for those named like a result, which
are replaced.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound, words

#: The characters that count as symbols.
SYMBOLS = "#*$%&|<>"
#: Frequent function words by language; one list serves all rows, as `lang` may be wrong.
STOP_WORDS = {
    "en": "the be to of and that have with in is it for was on are as at by this from or an not he she they you".split(),
    "fr": "le la les de des du et un une en est que qui dans pour pas sur au il elle ce se par avec ne plus".split(),
    "de": "der die das und ist ein eine zu den dem von mit auf für nicht im des sich es auch als an er sie".split(),
    "es": "el la los las de y que en un una es por para con no se del al lo su como más o do a".split(),
}
WINDOW = 5


class Rule(NamedTuple):
    """A measure is in order within low..high; None leaves a side open."""

    measure: str
    low: float | None
    high: float | None


#: The threshold table. Ratios are to words but for lines, which are to lines with a word.
RULES = (
    Rule("n_words", 10, None),
    Rule("repeat_ratio", None, 0.20),
    Rule("mean_word_chars", 2.0, 16.0),
    Rule("symbol_ratio", None, 0.10),
    Rule("dup_line_ratio", None, 0.50),
    Rule("stop_word_ratio", 0.02, None),
)


def repeated_words(ws: Column) -> Column:
    """How many words stand in 5-word windows that the text holds twice or more, the first included.

    Windows are compared by a 64-bit hash first; only texts with two equal hashes sort theirs, and
    neighbours with equal hashes are held against each other word by word.
    """
    n = F.size(ws)

    def chained(a: Column, b: Column, skip: Column | int, size: Column) -> Column:
        """Hashes of what a has at each place with what b has `skip` places on."""
        at = lambda x, k: F.slice(x, k, F.greatest(size, F.lit(0)))
        return F.zip_with(at(a, 1), at(b, skip + 1), lambda x, y: F.xxhash64(x, y))

    def covered(hashes: Column) -> Column:
        s = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def count(s: Column) -> Column:
            window = lambda x: F.slice(ws, x["i"] + 1, WINDOW)
            same = lambda x, y: (x["h"] == y["h"]) & (window(x) == window(y))
            last = F.size(s) - 1
            repeated = F.filter(
                s,
                lambda x, j: ((j > 0) & same(x, F.get(s, j - 1))) | ((j < last) & same(x, F.get(s, j + 1))),
            )
            # Each window adds the words up to the next one's start, five at most.
            return F.aggregate(
                F.array_sort(F.transform(repeated, lambda x: x["i"])),
                F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).cast("int").alias("p")),
                lambda acc, p: F.struct((acc["n"] + F.least(F.lit(WINDOW), p - acc["p"])).alias("n"), p.alias("p")),
                lambda acc: acc["n"],
            )

        return bound(s, count)

    def with_words(one: Column) -> Column:
        return bound(chained(one, one, 1, n - 1), lambda two: with_pairs(one, two))

    def with_pairs(one: Column, two: Column) -> Column:
        five = chained(chained(two, two, 2, n - 3), one, 4, n - 4)
        return bound(
            five,
            lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(F.lit(0).cast("long")),
        )

    return bound(F.transform(ws, lambda w: F.xxhash64(w)), with_words)


def counts(text: Column) -> Column:
    """The counts of a text that the rules use, as a struct."""
    raw = F.coalesce(text, F.lit(""))
    stop = sorted({w for ws in STOP_WORDS.values() for w in ws})

    def of_lines(lines: Column) -> tuple[Column, Column]:
        return F.size(lines).cast("long"), (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")

    def with_both(ws: Column, lines: Column) -> Column:
        symbols = reduce(lambda a, b: a + b, (F.length(raw) - F.length(F.replace(raw, F.lit(c))) for c in SYMBOLS))
        n_lines, n_dup_lines = of_lines(lines)
        return F.struct(
            F.size(ws).cast("long").alias("n_words"),
            F.length(F.array_join(ws, "")).cast("long").alias("word_chars"),
            symbols.cast("long").alias("n_symbols"),
            n_lines.alias("n_lines"),
            n_dup_lines.alias("n_dup_lines"),
            repeated_words(ws).alias("n_repeat_words"),
            F.size(F.filter(ws, lambda w: F.lower(w).isin(stop))).cast("long").alias("n_stop_words"),
        )

    worded = F.filter(F.split(raw, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return bound(words(text), lambda ws: bound(worded, lambda lines: with_both(ws, lines)))


def compile_rules(m: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """One boolean: every rule of the table holds for the measures m."""
    tests = [F.lit(True)]
    for r in rules:
        if r.low is not None:
            tests.append(m[r.measure] >= r.low)
        if r.high is not None:
            tests.append(m[r.measure] <= r.high)
    return reduce(lambda a, b: a & b, tests)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_stop_words")
#: Ratios: a count over another, 0 where that is 0.
RATIOS = {
    "repeat_ratio": ("n_repeat_words", "n_words"),
    "mean_word_chars": ("word_chars", "n_words"),
    "symbol_ratio": ("n_symbols", "n_words"),
    "dup_line_ratio": ("n_dup_lines", "n_lines"),
    "stop_word_ratio": ("n_stop_words", "n_words"),
}
RESULTS = (*COUNTS, *RATIOS, "base_failed", "kept")


def verdict(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """All measures of a text, `base_failed` and `kept`, as a struct."""

    def measured(c: Column) -> Column:
        per = lambda a, b: F.when(c[b] > 0, c[a] / c[b]).otherwise(F.lit(0.0))
        failed = (c["n_words"] < 10) | (c["n_repeat_words"] * 100 > c["n_words"] * 20)
        return F.struct(*(c[k].alias(k) for k in COUNTS), *(per(a, b).alias(k) for k, (a, b) in RATIOS.items()), failed.alias("base_failed"))

    def judged(m: Column) -> Column:
        kept = ~m["base_failed"] & compile_rules(m, rules)
        return F.struct(*(m[k].alias(k) for k in RESULTS[:-1]), kept.alias("kept"))

    return bound(bound(counts(text), measured), judged)


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """docs with all measures, `base_failed` and `kept`."""
    docs = docs.drop(*(c for c in RESULTS if c != text))
    return docs.select("*", F.inline(F.array(verdict(F.col(text), rules))))
