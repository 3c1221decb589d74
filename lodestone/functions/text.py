"""Column functions on text: quality, normal forms, field parsing, rule dictionaries.

All are built-in expressions. Patterns carry (?iu) or (?U) where letters beyond ASCII must match.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Letters that count for the scan test.
LETTER = "[а-яА-ЯёЁa-zA-Z]"
MIN_QUALITY_CHARS, MIN_ALPHA_SHARE, MIN_SCAN_LETTERS = 100, 0.3, 100
_WHITE = r"(?U)\s+"


def stripped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def collapsed(text: Column) -> Column:
    """White space runs as one blank, none at the ends."""
    return F.trim(F.regexp_replace(text, _WHITE, " "))


def quality(text: Column) -> Column:
    """none, poor or good: blank; short or with few letters; the rest."""
    body = stripped(F.coalesce(text, F.lit("")))
    n = F.length(body)
    letters = F.regexp_count(body, F.lit(r"\p{L}"))
    poor = (n < MIN_QUALITY_CHARS) | (letters / n < MIN_ALPHA_SHARE)
    return F.when(n == 0, F.lit("none")).when(poor, F.lit("poor")).otherwise(F.lit("good"))


def letters(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(LETTER))


def page_class(pages: Column, text: Column, has_table: Column, subclass: Column) -> Column:
    """scan without pages or with few letters, text without tables, else the subclass or pdf_tables."""
    scan = (F.coalesce(pages, F.lit(0)) == 0) | (letters(text) < MIN_SCAN_LETTERS)
    return F.when(scan, F.lit("scan")).when(~F.coalesce(has_table, F.lit(False)), F.lit("text")).otherwise(F.coalesce(subclass, F.lit("pdf_tables")))


def joined_single_letters(text: Column) -> Column:
    """Runs of single letters with blanks between them become words; other words stay."""
    return F.regexp_replace(text, rf"(?U)(?<![\w])({LETTER})\s+(?={LETTER}(?![\w]))", "$1")


def first_rule(text: Column, rules: Iterable[tuple[str, str]]) -> Column:
    """The name of the first rule (name, pattern) that matches, in the order given; null if none does."""
    out = F.lit(None).cast("string")
    for name, pattern in reversed(list(rules)):
        out = F.when(text.rlike(f"(?iu){pattern}"), F.lit(name)).otherwise(out)
    return out


def only_rule(text: Column, rules: Iterable[tuple[str, str]]) -> Column:
    """The name of the rule that matches where exactly one does."""
    hits = F.array_compact(F.array(*(F.when(text.rlike(f"(?iu){p}"), F.lit(n)) for n, p in rules)))
    return F.when(F.size(hits) == 1, F.get(hits, 0))


def head_tail(text: Column, limit: int, mark: str = "\n...[TRUNCATED]...\n") -> Column:
    """Texts over the limit as their first and last half around a mark."""
    half = limit // 2
    cut = F.concat(F.substring(text, 1, half), F.lit(mark), F.right(text, F.lit(half)))
    return F.when(F.length(text) > limit, cut).otherwise(text)


def without_reasoning(text: Column) -> Column:
    return stripped(F.regexp_replace(text, r"(?is)<think>.*?</think>|^.*?</think>", ""))


def field(raw: Column, name: str) -> Column:
    """What follows `name:` on its own line; null where it is missing or empty.

    Only blanks and tabs may stand around the sign, so an empty field doesn't take the next line.
    """
    found = F.trim(F.regexp_extract(F.coalesce(raw, F.lit("")), rf"(?iu){name}[ \t]*[:\-–—][ \t]*([^\r\n]*)", 1))
    return F.when(found != "", found)


def canonical_type(name: Column, none: str) -> Column:
    """Trimmed, lower case, ё as е, single blanks, first letter capital; empty becomes `none`."""
    plain = collapsed(F.replace(F.lower(F.coalesce(name, F.lit(""))), F.lit("ё"), F.lit("е")))
    return F.when(plain == "", F.lit(none)).otherwise(F.concat(F.upper(F.substring(plain, 1, 1)), F.substring(plain, 2, 1 << 30)))


def directory_name(name: Column, limit: int = 48) -> Column:
    plain = F.substring(F.trim(F.regexp_replace(F.coalesce(name, F.lit("")), r"(?U)[^\w\-]+", "_")), 1, limit)
    return F.when(plain == "", F.lit("x")).otherwise(plain)


def tsv(text: Column) -> Column:
    """Tab runs as one tab, lines trimmed, empty lines gone."""
    lines = F.transform(F.split(text, r"\r?\n"), lambda x: F.regexp_replace(F.regexp_replace(x, r"\t+", "\t"), r"(?U)^\s+|\s+$", ""))
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


def most_alphabetic(line: Column, separator: str = "\t") -> Column:
    """The cell with the most letters, the first of several; trailing numbers are cut off it."""
    scored = F.transform(F.split(line, separator), lambda c, i: F.struct(F.regexp_count(c, F.lit(r"\p{L}")).alias("n"), (-i).alias("i"), c.alias("c")))
    return F.regexp_replace(F.trim(F.array_max(scored)["c"]), r"[\s\d.,]+$", "")


def csv_line(cells: Column) -> Column:
    """Cells trimmed and joined by a bar, empty ones left out."""
    return F.concat_ws(" | ", F.filter(F.transform(cells, lambda c: F.trim(c)), lambda c: c != ""))


def without_markup(text: Column) -> Column:
    """Markdown links unwrapped, then images and tags removed, at most one empty line in a row."""
    out = F.regexp_replace(text, r"\[([^\]]*)\]\([^)]*\)", "$1")
    out = F.regexp_replace(out, r"!\[[^\]]*\]\([^)]*\)", "")
    out = F.regexp_replace(out, "<[^>]+>", "")
    return stripped(F.regexp_replace(out, r"\n{3,}", "\n\n"))


def tag_free(text: Column) -> Column:
    return collapsed(F.regexp_replace(text, "<[^>]+>", " "))


def cleaned(text: Column, limit: int) -> Column:
    return F.rtrim(F.substring(collapsed(F.coalesce(text, F.lit(""))), 1, limit))


def recognised(text: Column) -> Column:
    """The form in which recognised texts are compared: lower case, no tags, bars or rulers, single blanks."""
    out = F.replace(F.lower(F.coalesce(text, F.lit(""))), F.lit("ё"), F.lit("е"))
    for pattern in ("<[^>]+>", r"[|#]+", r"[-=_*]{3,}"):
        out = F.regexp_replace(out, pattern, " ")
    return collapsed(out)


def recognised_words(text: Column) -> Column:
    """Its words; an empty text has one empty word."""
    return F.split(recognised(text), " ")


def cyrillic_share(text: Column) -> Column:
    raw = F.coalesce(text, F.lit(""))
    n = F.regexp_count(raw, F.lit(r"\p{L}"))
    return F.when(n > 0, F.regexp_count(raw, F.lit("[а-яА-ЯёЁ]")) / n).otherwise(F.lit(0.0))


def duplicate_key(text: Column, limit: int | None = 8000) -> Column:
    """Lower case, single blanks, digit runs as 0, cut at the limit; None leaves it whole."""
    form = F.regexp_replace(collapsed(F.lower(F.coalesce(text, F.lit("")))), "[0-9]+", "0")
    return form if limit is None else F.substring(form, 1, limit)


def without_nul(text: Column) -> Column:
    return F.translate(text, "\x00", "")


def code(answer: Column, valid: list[str]) -> Column:
    """The valid code that an answer names first, NONE, or PARSE_FAIL."""
    raw = F.upper(F.coalesce(answer, F.lit("")))
    found = F.filter(F.regexp_extract_all(raw, F.lit(r"[A-Z0-9_]+"), F.lit(0)), lambda w: w.isin([*valid, "NONE"]))
    return F.when(F.size(found) > 0, F.get(found, 0)).otherwise(F.lit("PARSE_FAIL"))


#: Opening words of phrases that say nothing about the subject.
RITUAL = (
    "товары переданы", "услуги оказаны", "работы выполнены", "реализация", "стороны по объему", "товары и услуги принял",
    "регистрация счет-фактуры", "оказание услуг", "товар (груз)", "работы (услуги)", "передача тов/раб/усл", "работы сданы", "-", "—",
)


def ritual(phrase: Column) -> Column:
    low = F.trim(F.lower(F.coalesce(phrase, F.lit(""))))
    return (F.length(low) < 4) | reduce(lambda a, b: a | b, (low.startswith(p) for p in RITUAL))


def term_words(text: Column) -> Column:
    """Words of two characters or more that begin with a letter, in lower case."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}_][\p{L}\p{N}_]+"), F.lit(0))


def compressed_runs(items: Column) -> Column:
    """Runs of equal neighbours as `item (×n)`, single ones as they are."""
    begin = F.array().cast("array<struct<item:string,n:int>>")

    def step(acc: Column, x: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        one = lambda n: F.array(F.struct(x.alias("item"), n.cast("int").alias("n")))
        longer = F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), one(last["n"] + 1))
        return F.when((F.size(acc) > 0) & (last["item"] == x), longer).otherwise(F.concat(acc, one(F.lit(1))))

    runs = F.aggregate(items, begin, step)
    return F.transform(runs, lambda r: F.when(r["n"] > 1, F.concat(r["item"], F.lit(" (×"), r["n"].cast("string"), F.lit(")"))).otherwise(r["item"]))


def term_noise_free(text: Column) -> Column:
    """text without kind and unit marks and without prepositions, for top terms."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\b(?:вид|ед):[^\s;\]}]+", " ")
    return F.regexp_replace(bare, r"(?iuU)(?<!\w)(?:на|по|за|от|в|к|с|и|об|до|из|вид|ед|шт)(?!\w)", " ")


def theme_name(label: Column, names: dict[str, str], words: Column, rest: str) -> Column:
    """Name to show for a theme label: noise is `rest`, T<n> its given name, D<n> with the first three of its words."""
    given = reduce(lambda out, kv: F.when(label == kv[0], kv[1]).otherwise(out), names.items(), label)
    drift = F.concat(label, F.lit(" "), F.array_join(F.slice(F.split(F.coalesce(words, F.lit("")), ", "), 1, 3), " "))
    return F.when(label == "noise", rest).when(label.startswith("T"), given).when(label.rlike("^D[0-9]+$"), drift).otherwise(label)


def variant(override: Column, setting: Column) -> Column:
    """Name of the variant in use: the override if there is one, else the setting if it isn't empty, else default.

    A name that is no identifier is an error when the row is read.
    """
    name = F.coalesce(override, F.when(setting != "", setting), F.lit("default"))
    return F.when(name.rlike("^[A-Za-z_][A-Za-z0-9_]*$"), name).otherwise(F.raise_error(F.concat(F.lit("not a variant name: "), name)))
