"""Column functions on what models and forms answer: key lines, references and periods, parameters, aliases."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The names that a key line begins with, by field.
KEYS = {"topic": ("ТЕМА", "TOPIC"), "type": ("ТИП", "TYPE"), "purpose": ("НАЗНАЧЕНИЕ", "SUMMARY")}
_THOUGHT = (r"(?s)<think[\s>].*?</think\s*>", r"(?s)<thinking[\s>].*?</thinking\s*>")
_MARKS = r"\*{1,2}|_{1,2}|`{1,3}"
_LINE = r"(?iu)^(?:{})\s*[:\-–—]\s*"
_AND_SO_ON = r"(?iu)\s*и\s*т\.д\.?\s*$"
#: The prompt's own words, which a model may give back before its answer.
ECHOES = {
    "topic": (r"широкая предметная область\s*\(?1[–\-]3 слова\)?", r"одно[- ]два слова", r"предметная область"),
    "type": (r"конкретный вид документа", r"название вида документа", r"вид документа"),
}


def _bare(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.trim(c), _MARKS, ""))


def answer_parts(answer: Column) -> Column:
    """struct(topic, type, purpose) of a model's answer; null where it names none.

    Thoughts and marks of emphasis go. A line that begins with a key sets its field, if it says anything; a
    line without one goes on with the last field named.
    """
    raw = reduce(lambda c, p: F.regexp_replace(c, p, ""), _THOUGHT, F.trim(F.coalesce(answer, F.lit(""))))
    lines = F.filter(F.transform(F.split(raw, "\n"), lambda x: F.trim(x, F.lit(" \t\r\x0b\x0c"))), lambda x: x != "")
    lines = F.transform(lines, lambda x: _bare(F.regexp_replace(x, r"^[\d.)\-*]+\s*", "")))
    start = F.struct(*(F.lit("").alias(f) for f in KEYS), F.lit("").alias("now"))

    def step(state: Column, line: Column) -> Column:
        named = F.lit("")
        for f, names in KEYS.items():
            named = F.when(line.rlike(_LINE.format("|".join(names))), F.lit(f)).otherwise(named)
        value = _bare(F.regexp_replace(line, _LINE.format("|".join(n for names in KEYS.values() for n in names)), ""))
        begins = reduce(lambda a, b: a | b, (F.startswith(line, F.lit(n)) for names in KEYS.values() for n in names))
        more = (named == "") & (line != "") & ~begins
        field = lambda f: (
            F.when((named == f) & (value != ""), value).when(more & (state["now"] == f), F.concat(state[f], F.lit(" "), line)).otherwise(state[f]).alias(f)
        )
        return F.struct(*(field(f) for f in KEYS), F.when(named != "", named).otherwise(state["now"]).alias("now"))

    def plain(c: Column, f: str) -> Column:
        for p in ECHOES.get(f, ()):
            c = F.trim(F.regexp_replace(c, rf"(?iu)^{p}\s*[:\-–—]\s*", ""))
        c = F.regexp_replace(c, _AND_SO_ON, "") if f in ECHOES else c
        c = F.trim(F.regexp_replace(c, r"[,.]+$", "")) if f in ECHOES else F.trim(c)
        return F.when(c != "", c).alias(f)

    return F.aggregate(lines, start, step, lambda s: F.struct(*(plain(s[f], f) for f in KEYS)))


def enriched(parts: Column, original: Column) -> Column:
    """The fields as one text: a topic takes the original's place, type and purpose are added; neither topic nor type, the original."""
    tag = lambda name, f: F.when(parts[f].isNotNull(), F.concat(F.lit(f"[{name}: "), parts[f], F.lit("]"))).otherwise(F.lit(""))
    first = F.when(parts["topic"].isNotNull(), F.concat(tag("Тема", "topic"), F.lit(" "))).otherwise(original)
    second = F.when(parts["type"].isNotNull(), F.concat(tag("Тип", "type"), F.lit(" "))).otherwise(F.lit(""))
    return F.when(parts["topic"].isNull() & parts["type"].isNull(), original).otherwise(F.concat(first, second, tag("Назначение", "purpose")))


#: What a reference to a contract and a period look like. Numbers are taken without a way back,
#: as nothing after them must match, so a long row of them needs no stack.
_CONTRACT = r"""(?iuU)\s*,?\s*(?:по|согласно|в\s+рамках|к)?\s*(?:договор(?:у|а|ом|е)?|дс|доп(?:\.|олнени(?:ю|ем|е|я))?|соглашени(?:ю|е|я|ем|и)?)\s*(?:№|N)?\s*(?:[«"\w\-/\\.\[\]()&&[^\d]]*+\d[«"\w\-/\\.\[\]()]*+\s*+)++(?:от\s+[\d.]+\s*г?\.?)?\s*[,.]?\s*"""
_MONTH = r"(?:январ[ьяею]?|феврал[ьяею]?|март[аеу]?|апрел[ьяею]?|ма[йяею]|июн[ьяею]?|июл[ьяею]?|август[аеу]?|сентябр[ьяею]?|октябр[ьяею]?|ноябр[ьяею]?|декабр[ьяею]?)"
_PERIOD = (
    rf"(?iuU)\s*за\s+(?:период\s+)?(?:с\s+[\d.]+\s+по\s+[\d.]+\s*г?\.?|(?:\w+-\w+|{_MONTH})[\s,.]*\d{{0,4}}\s*г?\.?)"
    rf"|\s*в\s+{_MONTH}\s+(?:месяце\s+)?\d{{4}}\s*г?\.?|\s+{_MONTH}\s+\d{{4}}\s*г?\.?"
)


def _ahead(pattern: str, first: str) -> str:
    """The pattern, tried only where what it begins with can follow: most places of a text are passed over at once."""
    return f"(?iuU)(?={first})(?:{pattern.removeprefix('(?iuU)')})"


_CONTRACT_THERE = _ahead(_CONTRACT, r"[\s,]*+[псвкд]")


def without_references(text: Column) -> Column:
    """The text without contract references and periods; where less than 5 characters are left, the text itself.

    Taking a reference out may make another, so it is done until none is left: each time takes a digit, so
    there are no more turns than digits, and once none was found the text isn't looked at again.
    """
    text = text.cast("string")
    turns = F.sequence(F.lit(0), F.length(F.regexp_replace(text, "[^0-9]", "")))
    left = lambda t, more: F.struct(t.alias("t"), more.alias("more"))
    # What is taken out holds a digit, so a text that stays the same had nothing.
    once = lambda s: F.get(F.transform(F.array(F.regexp_replace(s["t"], _CONTRACT_THERE, " ")), lambda t: left(t, t != s["t"])), 0)
    turn = lambda s, _: F.when(s["more"], once(s)).otherwise(s)
    out = F.aggregate(turns, left(text, F.lit(True)), turn, lambda s: s["t"])
    for pattern, by in ((_PERIOD, " "), (r"\s*[,;]\s*[,;.]+", ", "), (r"\s+([,;.])", "$1"), (r"\s+", " ")):
        out = F.regexp_replace(out, pattern, by)
    out = F.trim(out, F.lit(" ,;."))
    return F.when(F.length(out) >= 5, out).otherwise(text)


def first_words(text: Column, n: int) -> Column:
    """The first n words, for a catalogue of themes."""
    return F.array_join(F.slice(F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda w: w != ""), 1, n), " ")


def parameter(item: Column) -> Column:
    """struct(name, value, kind) of `name=value`: kind is what the value is as JSON, or text; null without a sign or a name."""
    name, value = F.trim(F.substring_index(item, "=", 1)), F.substring(item, F.locate("=", item) + 1, F.length(item))
    kind = F.when(value.rlike(r"^\s*(?:true|false)\s*$"), "boolean").when(value.rlike(r"^\s*-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][+-]?\d+)?\s*$"), "number")
    kind = kind.when(value.rlike(r"^\s*null\s*$"), "null").when(value.rlike(r"(?s)^\s*[\[{].*[\]}]\s*$"), "json").when(value.rlike(r'^\s*"[^"\\]*"\s*$'), "string").otherwise("text")
    return F.when(F.contains(item, F.lit("=")) & (name != ""), F.struct(name.alias("name"), value.alias("value"), kind.alias("kind")))


def aliased(name: Column, codes: list[Column], aliases: dict[str, str], by_code: dict[str, str]) -> Column:
    """The region that a name stands for, else that of the first two digits of the first code that has one."""
    table = lambda d: F.create_map(*(F.lit(x) for kv in d.items() for x in kv))
    known = F.element_at(table(aliases), F.lower(F.trim(name)))
    return F.coalesce(known, *(F.element_at(table(by_code), F.substring(c, 1, 2)) for c in codes))


#: The last part of an OpenDocument type and the kind that it names.
OPEN_KINDS = {"text": "odt", "spreadsheet": "ods", "presentation": "odp", "graphics": "odg"}


def open_document_kind(xml: Column) -> Column:
    """odt, ods, odp or odg of flat OpenDocument XML, `opendocument` where it names no kind, null for other XML."""
    found = F.regexp_extract(xml, r"application/vnd\.oasis\.opendocument\.([a-z]+)", 1)
    kind = F.element_at(F.create_map(*(F.lit(x) for kv in OPEN_KINDS.items() for x in kv)), found)
    return F.when(F.contains(xml, F.lit("urn:oasis:names:tc:opendocument")) | (found != ""), F.coalesce(kind, F.lit("opendocument")))


def subject_lines(table: Column, words: list[str], most: int = 6, shortest: int = 15, longest: int = 600) -> Column:
    """Lines of a tab-separated text that name one of the words, at most six, as one text; null if that is too short."""
    lines = F.filter(F.split(table, "\n"), lambda x: F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(F.lower(x), w)))
    out = F.substring(F.array_join(F.transform(F.slice(lines, 1, most), lambda x: F.trim(F.regexp_replace(x, r"\s+", " "))), "; "), 1, longest)
    return F.when(F.length(out) >= shortest, out)


def gram_buckets(text: Column, low: int = 3, high: int = 5) -> Column:
    """Counts of the character n-grams of each word between blanks, in 4,096 buckets by their hash, as a map."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+"), lambda w: w != "")
    padded = F.transform(words, lambda w: F.concat(F.lit(" "), w, F.lit(" ")))
    cut = lambda n: F.flatten(F.transform(padded, lambda w: F.transform(F.filter(F.sequence(F.lit(1), F.length(w)), lambda i: i <= F.length(w) - n + 1), lambda i: F.substring(w, i, F.lit(n)))))
    grams = F.concat(*(cut(n) for n in range(low, high + 1)))
    return F.transform(grams, lambda g: F.substring(F.md5(g), 1, 3))
