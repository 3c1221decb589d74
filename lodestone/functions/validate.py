"""Tax numbers, counterparties, and comparison of an extracted value with a reference value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Weights of the check digits of a 10-digit number, and of a 12-digit number's last two.
WEIGHTS_10 = (2, 4, 10, 3, 5, 9, 4, 6, 8)
WEIGHTS_12 = ((7, 2, 4, 10, 3, 5, 9, 4, 6, 8), (3, 7, 2, 4, 10, 3, 5, 9, 4, 6, 8))
#: Legal forms as phrases, removed in this order, and as words.
LEGAL_PHRASES = (
    "ОБЩЕСТВО С ОГРАНИЧЕННОЙ ОТВЕТСТВЕННОСТЬЮ",
    "ПУБЛИЧНОЕ АКЦИОНЕРНОЕ ОБЩЕСТВО",
    "НЕПУБЛИЧНОЕ АКЦИОНЕРНОЕ ОБЩЕСТВО",
    "ЗАКРЫТОЕ АКЦИОНЕРНОЕ ОБЩЕСТВО",
    "ОТКРЫТОЕ АКЦИОНЕРНОЕ ОБЩЕСТВО",
    "АКЦИОНЕРНОЕ ОБЩЕСТВО",
    "ИНДИВИДУАЛЬНЫЙ ПРЕДПРИНИМАТЕЛЬ",
    "ФЕДЕРАЛЬНОЕ ГОСУДАРСТВЕННОЕ УНИТАРНОЕ ПРЕДПРИЯТИЕ",
    "ГОСУДАРСТВЕННОЕ УНИТАРНОЕ ПРЕДПРИЯТИЕ",
    "МУНИЦИПАЛЬНОЕ УНИТАРНОЕ ПРЕДПРИЯТИЕ",
)
LEGAL_WORDS = "ООО АО ПАО ЗАО ОАО НАО ИП ГУП МУП ФГУП ФГБУ ГБУ АНО ФОНД ТСЖ СНТ ПК".split()
MIN_CONTAINED, MIN_RATIO = 4, 85.0


def _check_digit(number: Column, weights: tuple[int, ...]) -> Column:
    digits = F.transform(F.split(F.substring(number, 1, len(weights)), ""), lambda d: d.try_cast("int"))
    products = F.zip_with(F.slice(digits, 1, len(weights)), F.array(*map(F.lit, weights)), lambda d, w: d * w)
    return F.aggregate(products, F.lit(0), lambda a, x: a + x) % 11 % 10


def tax_number_holds(number: Column) -> Column:
    """Whether a 10- or 12-digit number's check digits hold; false for null and all else."""
    digit = lambda at: F.substring(number, at, 1).try_cast("int")
    ten = _check_digit(number, WEIGHTS_10) == digit(10)
    twelve = (_check_digit(number, WEIGHTS_12[0]) == digit(11)) & (_check_digit(number, WEIGHTS_12[1]) == digit(12))
    holds = F.when(number.rlike(r"^[0-9]{10}\z"), ten).when(number.rlike(r"^[0-9]{12}\z"), twelve)
    return F.coalesce(holds, F.lit(False))


def counterparty(raw: Column) -> Column:
    """struct(name, inn, kpp, region) of `name | INN .. | KPP .. | region`; what is missing is null."""
    parts = F.transform(F.split(F.coalesce(raw, F.lit("")), r"\|"), lambda p: F.trim(p))
    part = lambda i: F.get(parts, i)
    some = lambda c: F.when(c != "", c)
    return F.struct(
        some(part(0)).alias("name"),
        some(F.regexp_extract(F.coalesce(part(1), F.lit("")), r"[0-9]{12}|[0-9]{10}", 0)).alias("inn"),
        some(F.regexp_extract(F.coalesce(part(2), F.lit("")), r"[0-9]{9}", 0)).alias("kpp"),
        some(part(3)).alias("region"),
    )


def is_own(name: Column, own: str) -> Column:
    """Whether a name matches the pattern of the own company; false for null."""
    return F.coalesce(name.rlike(f"(?iu){own}"), F.lit(False))


def stands_in(value: Column, text: Column) -> Column:
    """Whether the source text, blanks left out, holds the value."""
    return F.coalesce(F.contains(F.replace(text, F.lit(" "), F.lit("")), value), F.lit(False))


def digits_status(found: Column, known: Column) -> Column:
    a, b = (F.regexp_replace(F.coalesce(c, F.lit("")), "[^0-9]", "") for c in (found, known))
    both = F.when((a == "") & (b == ""), "both_missing").when(a == "", "llm_missing").when(b == "", "edo_missing")
    return both.when(a == b, "match").otherwise("mismatch")


def plain_name(name: Column) -> Column:
    """Upper case, Ё as Е, without legal forms and signs."""
    out = F.replace(F.upper(F.coalesce(name, F.lit(""))), F.lit("Ё"), F.lit("Е"))
    for phrase in LEGAL_PHRASES:
        out = F.replace(out, F.lit(phrase), F.lit(" "))
    words = F.regexp_extract_all(out, F.lit("[А-ЯA-Z0-9]+"), F.lit(0))
    return F.array_join(F.filter(words, lambda w: ~w.isin(LEGAL_WORDS)), " ")


def sorted_words(name: Column) -> Column:
    return F.array_join(F.array_sort(F.split(name, " ")), " ")


def common_subsequence(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence: a row of the table for each character of a."""
    letters = lambda s: F.filter(F.split(s, ""), lambda c: c != "")
    theirs = letters(b)
    start = F.transform(theirs, lambda _: F.lit(0))

    def row(above: Column, x: Column) -> Column:
        diagonal = F.concat(F.array(F.lit(0)), above)
        cells = F.zip_with(F.zip_with(theirs, above, lambda y, up: F.struct(y.alias("y"), up.alias("up"))), diagonal, lambda c, d: F.struct(c["y"].alias("y"), c["up"].alias("up"), d.alias("d")))
        cells = F.filter(cells, lambda c: c["y"].isNotNull())
        # What a match or the row above gives, then the greatest so far from the left.
        own = F.transform(cells, lambda c: F.when(c["y"] == x, c["d"] + 1).otherwise(c["up"]))
        none = F.array().cast("array<int>")
        return F.aggregate(own, none, lambda acc, v: F.concat(acc, F.array(F.greatest(v, F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0))))))

    return F.coalesce(F.array_max(F.aggregate(letters(a), start, row)), F.lit(0))


def sorted_ratio(a: Column, b: Column) -> Column:
    """Similarity in percent of two names with their words in order: 200 * LCS / (both lengths)."""
    a, b = sorted_words(a), sorted_words(b)
    total = F.length(a) + F.length(b)
    return F.when(total == 0, F.lit(100.0)).otherwise(common_subsequence(a, b) * 200.0 / total)


def name_status(found: Column, short: Column, full: Column) -> Column:
    """match where a normal form equals or holds the other, or their ratio is high, for either known name."""
    blank = lambda c: F.trim(F.coalesce(c, F.lit(""))) == ""
    a = plain_name(found)

    def close(known: Column) -> Column:
        b = plain_name(known)
        held = (F.least(F.length(a), F.length(b)) >= MIN_CONTAINED) & (F.contains(a, b) | F.contains(b, a))
        return (b != "") & ((a == b) | held | (sorted_ratio(a, b) >= MIN_RATIO))

    status = F.when(blank(found), "llm_missing").when(blank(short) & blank(full), "edo_missing").when(a == "", "llm_missing")
    return status.when(close(short) | close(full), "match").otherwise("mismatch")
