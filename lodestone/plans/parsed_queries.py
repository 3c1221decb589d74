"""Queries of parsers on whole columns, with marks put into the texts where their own words stand.

Each twin in SQL puts in the same marks and parses what comes out, so places, repeats and mixtures are the
texts' own.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import answers as A, files, text as T
from ..operators import graph
from .catalog import query

NAMES = {f"T{k}": f"theme {k}" for k in range(5)}
#: What counts as part of a word, as a set of characters in SQL.
_WORD = r"\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}"

_NOISE = {" the ": " вид:", " of ": " на ", " and ": " По ", " de ": " [ед:", " la ": "; за-", " der ": " шт", "\n": " (из) "}
_STREAMS = {" that ": " Workbook ", " und ": " WordDocument ", " les ": "Book", " la ": " 1Table ", " was ": "PowerPoint Document"}
_OPEN = {
    " the ": " application/vnd.oasis.opendocument.text ", " la ": "=application/vnd.oasis.opendocument.presentation;",
    " und ": " urn:oasis:names:tc:opendocument:xmlns ", " que ": " application/vnd.oasis.opendocument.chart ", " les ": " application/vnd.oasis.opendocument. ",
}
_REFERENCES = {
    " the ": " по договору № 12/3-а от 01.02.2024 г. ", " of ": ", согласно ДС № 7, ", " and ": " к договору ", " is ": " 45/б ", " de ": " за март 2024 г., ",
    " der ": " в июне 2023 г. ", " la ": " за период с 01.02 по 03.04 ", " que ": " доп", " le ": " соглашение N ",
}
_ANSWERS = {
    ". ": "\nTOPIC: ", ", ": "\n- **TYPE** - ", " la ": "\nSummary: ", " the ": "\n \n", " of ": "<think>", " to ": "</think >", " is ": "\nТЕМА: одно два слова - ",
    " de ": "\nТИП: вид документа: ", " der ": "\nTOPICS ", " that ": " и т.д.\n", " and ": "\n2) `НАЗНАЧЕНИЕ`: ",
}
_ONES = dict.fromkeys((" the ", " of ", " and ", " de ", " der ", " la "), " 1 ")


def _marked(text: Column, marks: dict[str, str]) -> Column:
    return reduce(lambda c, m: F.replace(c, F.lit(m[0]), F.lit(m[1])), marks.items(), text)


def _sql_marked(text: str, marks: dict[str, str]) -> str:
    quoted = lambda s: "'" + s.replace("\n", "' || chr(10) || '") + "'"
    return reduce(lambda c, m: f"replace({c}, {quoted(m[0])}, {quoted(m[1])})", marks.items(), text)


@query(rf"""
WITH m AS (SELECT doc_id, regexp_replace(coalesce({_sql_marked('text', _NOISE)}, ''), '(^|[^{_WORD}])(?:вид|ед):[^\s;\]}}]+', '\1 ', 'g') AS x FROM documents)
SELECT doc_id, array_to_string(list_transform(regexp_extract_all(x, '[{_WORD}]+|[^{_WORD}]+'),
 lambda w: CASE WHEN lower(w) IN ('на', 'по', 'за', 'от', 'в', 'к', 'с', 'и', 'об', 'до', 'из', 'вид', 'ед', 'шт') THEN ' ' ELSE w END), '') AS terms FROM m""")
def terms_without_noise(t):
    return t.documents.select("doc_id", T.term_noise_free(_marked(F.col("text"), _NOISE)).alias("terms"))


@query(f"""
WITH l AS (SELECT doc_id, CASE lang WHEN 'en' THEN 'T' || (n_chars % 7) WHEN 'de' THEN 'D' || n_chars WHEN 'fr' THEN 'noise' ELSE 'D' || source END AS label,
 string_split(replace(coalesce(text, ''), ' ', ', '), ', ') AS words FROM documents)
SELECT doc_id, CASE WHEN label = 'noise' THEN 'other' {' '.join(f"WHEN label = '{k}' THEN '{v}'" for k, v in NAMES.items())}
 WHEN regexp_full_match(label, 'D[0-9]+') THEN label || ' ' || array_to_string(words[1:3], ' ') ELSE label END AS shown FROM l""")
def theme_names(t):
    size = F.col("n_chars").cast("string")
    label = (
        F.when(F.col("lang") == "en", F.concat(F.lit("T"), (F.col("n_chars") % 7).cast("string"))).when(F.col("lang") == "de", F.concat(F.lit("D"), size))
        .when(F.col("lang") == "fr", "noise").otherwise(F.concat(F.lit("D"), F.col("source")))
    )
    words = F.replace(F.col("text"), F.lit(" "), F.lit(", "))
    return t.documents.select("doc_id", T.theme_name(label, NAMES, words, "other").alias("shown"))


@query("""
WITH s AS (SELECT event_id, CAST(props ->> '$.k' AS INT) AS k, replace(event_type, 'view', '') AS setting FROM events)
SELECT event_id, CASE WHEN k < 40 THEN 'k_' || k WHEN setting <> '' THEN setting ELSE 'default' END AS variant FROM s""")
def variant_in_use(t):
    k = F.get_json_object("props", "$.k").cast("int")
    setting = F.replace(F.col("event_type"), F.lit("view"), F.lit(""))
    return t.events.select("event_id", T.variant(F.when(k < 40, F.concat(F.lit("k_"), k.cast("string"))), setting).alias("variant"))


@query(f"""
WITH m AS (SELECT page_id, url, coalesce(html, '') AS html, {_sql_marked("coalesce(html, '')", _STREAMS)} AS x FROM pages),
s AS (SELECT *, substr(x, 1, {(65536 - 6) // 2}) AS shown FROM m)
SELECT page_id, CASE WHEN contains(url, '?') THEN NULL WHEN contains(url, '.html') THEN CASE WHEN contains(html, 'lang="en"') THEN 'image' END
 WHEN contains(url, 'www.') THEN CASE WHEN html <> '' THEN 'text' END WHEN 6 + 2 * length(x) < 512 THEN NULL
 WHEN contains(shown, 'Workbook') THEN 'excel' WHEN contains(shown, 'WordDocument') THEN 'word' WHEN contains(shown, 'Book') THEN 'excel'
 WHEN contains(shown, 'PowerPoint Document') THEN 'word' WHEN contains(shown, '1Table') THEN 'word' END AS kind FROM s""")
def container_kinds(t):
    """Pages as compound files, RIFF files, broken archives and plain text, by their address."""
    html, url = F.coalesce("html", F.lit("")), F.col("url")
    plain, has = F.encode(html, "UTF-8"), lambda c, s: F.contains(c, F.lit(s))
    form = F.when(has(html, 'lang="en"'), "WEBP").otherwise("AVI ")
    content = (
        F.when(has(url, "?"), F.concat(F.unhex(F.lit("504B0304")), plain)).when(has(url, ".html"), F.encode(F.concat(F.lit("RIFF0000"), form, html), "UTF-8"))
        .when(has(url, "www."), plain).otherwise(F.concat(F.unhex(F.lit("D0CF11E0A1B1")), F.encode(_marked(html, _STREAMS), "UTF-16LE")))
    )
    return t.pages.select("page_id", files.kind(content).alias("kind"))


@query(f"""
WITH m AS (SELECT page_id, {_sql_marked('html', _OPEN)} AS x FROM pages),
p AS (SELECT *, list_filter(list_transform(string_split(x, 'application/vnd.oasis.opendocument.')[2:], lambda s: regexp_extract(s, '^[a-z]*')), lambda s: s <> '') AS named FROM m)
SELECT page_id, CASE named[1] WHEN 'text' THEN 'odt' WHEN 'spreadsheet' THEN 'ods' WHEN 'presentation' THEN 'odp' WHEN 'graphics' THEN 'odg'
 ELSE CASE WHEN len(named) > 0 OR contains(x, 'urn:oasis:names:tc:opendocument') THEN 'opendocument' END END AS kind FROM p""")
def open_document_kind(t):
    return t.pages.select("page_id", A.open_document_kind(_marked(F.col("html"), _OPEN)).alias("kind"))


@query(f"SELECT doc_id, coalesce(string_split(replace({_sql_marked('text', _ONES)}, ' ', '_'), '_')[8] = '1', false) AS marked FROM documents")
def marked_names(t):
    return t.documents.select("doc_id", files.is_marked(F.translate(_marked(F.col("text"), _ONES), " ", "_")).alias("marked"))


_TOKEN = rf'[«"{_WORD}\-/\\.\[\]()]*'
_CONTRACT = (
    r"(?i)\s*,?\s*(?:по|согласно|в\s+рамках|к)?\s*(?:договор(?:у|а|ом|е)?|дс|доп(?:\.|олнени(?:ю|ем|е|я))?|соглашени(?:ю|е|я|ем|и)?)\s*(?:№|N)?\s*"
    rf"(?:{_TOKEN}\d{_TOKEN}\s*)+(?:от\s+[\d.]+\s*г?\.?)?\s*[,.]?\s*"
)
_PERIOD = "(?i)" + A._PERIOD.removeprefix("(?iuU)").replace(r"\w", f"[{_WORD}]")


@query(rf"""
WITH RECURSIVE m AS (SELECT doc_id, {_sql_marked('text', _REFERENCES)} AS x FROM documents),
r AS (SELECT doc_id, x AS t, 0 AS i FROM m UNION ALL SELECT doc_id, regexp_replace(t, '{_CONTRACT}', ' ', 'g'), i + 1 FROM r WHERE regexp_matches(t, '{_CONTRACT}')),
d AS (SELECT doc_id, arg_max(t, i) AS t FROM r GROUP BY doc_id),
s AS (SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, '{_PERIOD}', ' ', 'g'), '\s*[,;]\s*[,;.]+', ', ', 'g'), '\s+([,;.])', '\1', 'g'), '\s+', ' ', 'g'), ' ,;.') AS s FROM d)
SELECT doc_id, CASE WHEN length(s) >= 5 THEN s ELSE x END AS subject FROM s JOIN m USING (doc_id)""")
def without_references(t):
    return graph.spread(t.documents.select("doc_id", "text")).select("doc_id", A.without_references(_marked(F.col("text"), _REFERENCES)).alias("subject"))


_EMPHASIS = r"\*{1,2}|_{1,2}|`{1,3}"
_SIGN = r"\s*[:\-–—]\s*"
_BARE = lambda c: f"trim(regexp_replace(trim({c}), '{_EMPHASIS}', '', 'g'))"


def _echoless(c: str, f: str) -> str:
    for p in A.ECHOES.get(f, ()):
        c = f"trim(regexp_replace({c}, '(?i)^{p}{_SIGN}', ''))"
    return rf"trim(regexp_replace(regexp_replace({c}, '(?i)\s*и\s*т\.д\.?\s*$', ''), '[,.]+$', ''))" if f in A.ECHOES else f"trim({c})"


def _field(f: str) -> str:
    value = f"string_agg(CASE WHEN i = at_{f} THEN value ELSE ' ' || line END, '' ORDER BY i) FILTER (WHERE i = at_{f} OR (more AND now = '{f}' AND i > coalesce(at_{f}, 0)))"
    return f"nullif({_echoless(f"coalesce({value}, '')", f)}, '') AS {f}"


@query(rf"""
WITH a AS (SELECT conv_id, turn, text, regexp_replace(regexp_replace(trim(coalesce({_sql_marked('text', _ANSWERS)}, '')), '(?s)<think[\s>].*?</think\s*>', '', 'g'), '(?s)<thinking[\s>].*?</thinking\s*>', '', 'g') AS raw FROM conversations),
u AS (SELECT conv_id, turn, unnest(string_split(raw, chr(10))) AS line, generate_subscripts(string_split(raw, chr(10)), 1) AS i FROM a),
l AS (SELECT conv_id, turn, i, {_BARE(r"regexp_replace(trim(line, ' ' || chr(9) || chr(13) || chr(11) || chr(12)), '^[\d.)\-*]+\s*', '')")} AS line FROM u),
n AS (SELECT *, {_BARE(f"regexp_replace(line, '(?i)^(?:{'|'.join(n for names in A.KEYS.values() for n in names)}){_SIGN}', '')")} AS value,
 CASE {' '.join(f"WHEN regexp_matches(line, '(?i)^(?:{'|'.join(names)}){_SIGN}') THEN '{f}'" for f, names in A.KEYS.items())} END AS named FROM l),
w AS (SELECT *, last_value(named IGNORE NULLS) OVER (PARTITION BY conv_id, turn ORDER BY i ROWS UNBOUNDED PRECEDING) AS now,
 named IS NULL AND line <> '' AND NOT ({' OR '.join(f"starts_with(line, '{n}')" for names in A.KEYS.values() for n in names)}) AS more,
 {', '.join(f"max(i) FILTER (WHERE named = '{f}' AND value <> '') OVER (PARTITION BY conv_id, turn) AS at_{f}" for f in A.KEYS)} FROM n),
g AS (SELECT conv_id, turn, {', '.join(_field(f) for f in A.KEYS)} FROM w GROUP BY conv_id, turn)
SELECT conv_id, turn, topic, type, purpose, CASE WHEN topic IS NULL AND type IS NULL THEN text ELSE
 CASE WHEN topic IS NULL THEN text ELSE '[Тема: ' || topic || '] ' END || CASE WHEN type IS NULL THEN '' ELSE '[Тип: ' || type || '] ' END
 || CASE WHEN purpose IS NULL THEN '' ELSE '[Назначение: ' || purpose || ']' END END AS enriched
FROM a LEFT JOIN g USING (conv_id, turn)""")
def answer_parser(t):
    parts = A.answer_parts(_marked(F.col("text"), _ANSWERS))
    rows = t.conversations.select("conv_id", "turn", "text", parts.alias("p"))
    return rows.select("conv_id", "turn", "p.*", A.enriched(F.col("p"), F.col("text")).alias("enriched"))
