"""Column functions over whole tables: file kinds, names, phrases, answers. Nulls count as empty."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import files, text as T, validate as C
from .catalog import query

#: Examples; a user passes their own.
CODES, OWN = ["BUILDING", "MACHINERY"], "0[0-9]*7$"


def _listed(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


@query("""
WITH c AS (SELECT page_id, CASE page_id % 3 WHEN 0 THEN '%PDF' WHEN 1 THEN '<?xml' ELSE '' END || coalesce(html, '') AS c FROM pages)
SELECT page_id, CASE WHEN c = '' THEN NULL WHEN starts_with(c, '%PDF') THEN 'pdf' WHEN starts_with(c, 'GIF87a') OR starts_with(c, 'GIF89a') OR starts_with(c, 'BM') THEN 'image'
WHEN starts_with(c, 'RIFF') THEN 'riff' WHEN starts_with(c, '{\\rtf') THEN 'word' WHEN starts_with(c, '<?xml') THEN 'xml' ELSE 'text' END AS category FROM c""")
def file_signature(t):
    begin = F.when(F.col("page_id") % 3 == 0, "%PDF").when(F.col("page_id") % 3 == 1, "<?xml").otherwise("")
    content = F.encode(F.concat(begin, F.coalesce("html", F.lit(""))), "UTF-8")
    return t.pages.select("page_id", files.signature(content).alias("category"))


@query(rf"SELECT doc_id, coalesce(octet_length(encode(text)) <= {files.GARBAGE_BYTES} OR len(regexp_split_to_array(trim(text), '\r\n|\r|\n')) <= {files.GARBAGE_LINES}, false) AS garbage FROM documents")
def garbage_files(t):
    return t.documents.select("doc_id", files.is_garbage(F.encode("text", "UTF-8")).alias("garbage"))


@query(r"SELECT page_id, lower(regexp_extract(url, '(\.[^./\\]+)$', 1)) AS extension FROM pages")
def file_extension(t):
    return t.pages.select("page_id", files.extension(F.col("url")).alias("extension"))


@query(f"SELECT c_custkey, coalesce(regexp_matches(c_name, '(?i){OWN}'), false) AS own FROM customer")
def own_company(t):
    return t.customer.select("c_custkey", C.is_own(F.col("c_name"), OWN).alias("own"))


@query("SELECT doc_id, coalesce(contains(replace(text, ' ', ''), CAST(doc_id % 100 AS VARCHAR)), false) AS stands FROM documents")
def value_in_source(t):
    return t.documents.select("doc_id", C.stands_in((F.col("doc_id") % 100).cast("string"), F.col("text")).alias("stands"))


def _without_phrases(name: str) -> str:
    for phrase in C.LEGAL_PHRASES:
        name = f"replace({name}, '{phrase}', ' ')"
    return name


_UPPER = "replace(upper(CASE c_custkey % 3 WHEN 0 THEN 'ООО ' WHEN 1 THEN 'ао \"Ёлка\" ' ELSE '' END || coalesce(c_name, '')), 'Ё', 'Е')"


@query(f"SELECT c_custkey, coalesce(array_to_string(list_filter(regexp_extract_all({_without_phrases(_UPPER)}, '[А-ЯA-Z0-9]+'), lambda w: w NOT IN ({_listed(C.LEGAL_WORDS)})), ' '), '') AS name FROM customer")
def plain_names(t):
    form = F.when(F.col("c_custkey") % 3 == 0, "ООО ").when(F.col("c_custkey") % 3 == 1, 'ао "Ёлка" ').otherwise("")
    return t.customer.select("c_custkey", C.plain_name(F.concat(form, F.coalesce("c_name", F.lit("")))).alias("name"))


@query(f"""
WITH p AS (SELECT n_nationkey, trim(lower(CASE n_nationkey % 3 WHEN 0 THEN 'Услуги оказаны ' || n_name WHEN 1 THEN substr(n_name, 1, 3) ELSE n_name END)) AS p FROM nation)
SELECT n_nationkey, length(p) < 4 OR len(list_filter([{_listed(T.RITUAL)}], lambda r: starts_with(p, r))) > 0 AS ritual FROM p""")
def ritual_phrases(t):
    key, name = F.col("n_nationkey"), F.col("n_name")
    phrase = F.when(key % 3 == 0, F.concat(F.lit("Услуги оказаны "), name)).when(key % 3 == 1, F.substring(name, 1, 3)).otherwise(name)
    return t.nation.select("n_nationkey", T.ritual(phrase).alias("ritual"))


@query(f"SELECT c_custkey, coalesce(list_filter(regexp_extract_all(upper('Code: ' || coalesce(c_mktsegment, '')), '[A-Z0-9_]+'), lambda w: w IN ({_listed([*CODES, 'NONE'])}))[1], 'PARSE_FAIL') AS code FROM customer")
def answer_code(t):
    return t.customer.select("c_custkey", T.code(F.concat(F.lit("Code: "), F.coalesce("c_mktsegment", F.lit(""))), CODES).alias("code"))


@query("SELECT doc_id, 'answer ' || doc_id AS answer FROM documents")
def answer_without_reasoning(t):
    raw = F.concat(F.lit("<think>"), F.coalesce("text", F.lit("")), F.lit("</think>\n answer "), F.col("doc_id").cast("string"))
    return t.documents.select("doc_id", T.without_reasoning(raw).alias("answer"))
