"""Text functions over `documents` and `pages`, validation over `customer`, duplicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import validate as C
from ..operators import dedup, sampling, similarity
from .catalog import query

#: White space as Unicode has it, in the SQL twins' dialect.
WS = r"[\s\x0b\x85\p{Z}]"
#: An example dictionary; a user passes their own.
RULES = (("license", "licen[sc]e"), ("contact", "@|phone"), ("web", r"http|www\."))


def _collapsed(value: str) -> str:
    return rf"trim(regexp_replace({value}, '{WS}+', ' ', 'g'))"


_WHOLE = rf"regexp_replace(trim(regexp_replace(lower(coalesce(text, '')), '{WS}+', ' ', 'g')), '[0-9]+', '0', 'g')"
_KEY = f"substr({_WHOLE}, 1, 8000)"


@query(rf"""
WITH s AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '^{WS}+|{WS}+$', '', 'g') AS t FROM documents),
c AS (SELECT doc_id, length(t) AS n, length(regexp_replace(t, '[^\p{{L}}]', '', 'g')) AS a FROM s)
SELECT doc_id, CASE WHEN n = 0 THEN 'none' WHEN n < 100 OR a / n < 0.3 THEN 'poor' ELSE 'good' END AS quality FROM c""")
def text_quality(t):
    return t.documents.select("doc_id", T.quality(F.col("text")).alias("quality"))


@query("SELECT doc_id, length(regexp_replace(coalesce(text, ''), '[^а-яА-ЯёЁa-zA-Z]', '', 'g')) AS letters FROM documents")
def letters_count(t):
    return t.documents.select("doc_id", T.letters(F.col("text")).cast("long").alias("letters"))


@query("SELECT doc_id, CASE WHEN regexp_matches(text, '(?i)licen[sc]e') THEN 'license' WHEN regexp_matches(text, '(?i)@|phone') THEN 'contact' WHEN regexp_matches(text, '(?i)http|www\\.') THEN 'web' END AS rule FROM documents")
def rule_classify(t):
    return t.documents.select("doc_id", T.first_rule(F.col("text"), RULES).alias("rule"))


@query("WITH h AS (SELECT doc_id, regexp_matches(text, '(?i)licen[sc]e') AS a, regexp_matches(text, '(?i)@|phone') AS b, regexp_matches(text, '(?i)http|www\\.') AS c FROM documents) SELECT doc_id, CASE WHEN a AND NOT b AND NOT c THEN 'license' WHEN b AND NOT a AND NOT c THEN 'contact' WHEN c AND NOT a AND NOT b THEN 'web' END AS rule FROM h")
def single_rule(t):
    return t.documents.select("doc_id", T.only_rule(F.col("text"), RULES).alias("rule"))


@query("WITH a AS (SELECT doc_id, text, n_chars % 3 AS pages, length(regexp_replace(coalesce(text, ''), '[^а-яА-ЯёЁa-zA-Z]', '', 'g')) AS l, contains(text, '<') AS tab FROM documents) SELECT doc_id, CASE WHEN pages = 0 OR l < 100 THEN 'scan' WHEN NOT tab THEN 'text' WHEN regexp_matches(text, '(?i)licen[sc]e') THEN 'license' WHEN regexp_matches(text, '(?i)@|phone') THEN 'contact' WHEN regexp_matches(text, '(?i)http|www\\.') THEN 'web' ELSE 'pdf_tables' END AS class FROM a")
def page_class(t):
    text = F.col("text")
    return t.documents.select("doc_id", T.page_class(F.col("n_chars") % 3, text, F.contains(text, F.lit("<")), T.first_rule(text, RULES)).alias("class"))


@query("SELECT doc_id, md5(CASE WHEN length(text) > 1000 THEN substr(text, 1, 500) || chr(10) || '...[TRUNCATED]...' || chr(10) || right(text, 500) ELSE text END) AS digest FROM documents")
def head_tail_trim(t):
    return t.documents.select("doc_id", F.md5(T.head_tail(F.col("text"), 1000)).alias("digest"))


@query(rf"SELECT doc_id, md5({_KEY}) AS group_key FROM documents")
def norm_dup_key(t):
    return t.documents.select("doc_id", F.md5(T.duplicate_key(F.col("text"))).alias("group_key"))


@query(rf"SELECT md5({_WHOLE}) AS group_key, count(*) AS n, min(doc_id) AS first FROM documents GROUP BY 1")
def exact_duplicates(t):
    return dedup.exact(t.documents, "doc_id")


@query()
def near_duplicates(t):
    return dedup.near(t.documents, "doc_id")


@query()
def near_duplicate_sweep(t):
    return similarity.sweep(t.documents, "doc_id")


@query()
def near_duplicate_spans(t):
    groups = similarity.sweep(t.documents, "doc_id").join(t.documents.select("doc_id", "source"), "doc_id")
    return similarity.spans(groups, "source")


@query()
def grouped_split(t):
    rows = t.documents.select("doc_id", "source").join(dedup.near(t.documents, "doc_id"), "doc_id")
    return sampling.grouped_split(rows, "doc_id", "source", "group_id").select("doc_id", "group_id", "split")


@query(rf"SELECT doc_id, md5(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(lower(coalesce(text, '')), 'ё', 'е'), '<[^>]+>', ' ', 'g'), '[|#]+', ' ', 'g'), '[-=_*]{{3,}}', ' ', 'g'), '{WS}+', ' ', 'g'))) AS digest FROM documents")
def ocr_normalise(t):
    return t.documents.select("doc_id", F.md5(T.recognised(F.col("text"))).alias("digest"))


@query("WITH c AS (SELECT doc_id, length(regexp_replace(coalesce(text, ''), '[^\\p{L}]', '', 'g')) AS n, length(regexp_replace(coalesce(text, ''), '[^а-яА-ЯёЁ]', '', 'g')) AS k FROM documents) SELECT doc_id, round(CASE WHEN n > 0 THEN k / n ELSE 0 END, 6) AS share FROM c")
def cyrillic_share(t):
    return t.documents.select("doc_id", F.round(T.cyrillic_share(F.col("text")), 6).alias("share"))


@query(rf"SELECT page_id, md5({_collapsed("regexp_replace(html, '<[^>]+>', ' ', 'g')")}) AS digest FROM pages")
def html_strip(t):
    return t.pages.select("page_id", F.md5(T.tag_free(F.col("html"))).alias("digest"))


@query(r"SELECT page_id, regexp_extract(url, '^([a-z]+)://([^/]+)', 1) AS scheme, regexp_extract(url, '^([a-z]+)://([^/]+)', 2) AS host FROM pages")
def url_parts(t):
    pattern = "^([a-z]+)://([^/]+)"
    return t.pages.select("page_id", F.regexp_extract("url", pattern, 1).alias("scheme"), F.regexp_extract("url", pattern, 2).alias("host"))


@query(rf"""
WITH a AS (SELECT page_id, regexp_replace(html, '\[([^\]]*)\]\([^)]*\)', '\1', 'g') AS h FROM pages),
b AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(h, '!\[[^\]]*\]\([^)]*\)', '', 'g'), '<[^>]+>', '', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g') AS h FROM a)
SELECT page_id, md5(regexp_replace(h, '^{WS}+|{WS}+$', '', 'g')) AS digest FROM b""")
def markdown_clean(t):
    return t.pages.select("page_id", F.md5(T.without_markup(F.col("html"))).alias("digest"))


@query(rf"SELECT doc_id, md5(rtrim(substr({_collapsed("coalesce(text, '')")}, 1, 300))) AS digest FROM documents")
def cleaned_text(t):
    return t.documents.select("doc_id", F.md5(T.cleaned(F.col("text"), 300)).alias("digest"))


@query("""
WITH s AS (SELECT c_custkey, lpad(CAST(c_custkey * 1000003 % 10000000000 AS VARCHAR), 10, '0') AS s FROM customer),
d AS (SELECT c_custkey, s, list_transform(range(1, 11), lambda i: CAST(substr(s, i, 1) AS INTEGER)) AS d FROM s)
SELECT c_custkey, s AS number, (d[1]*2 + d[2]*4 + d[3]*10 + d[4]*3 + d[5]*5 + d[6]*9 + d[7]*4 + d[8]*6 + d[9]*8) % 11 % 10 = d[10] AS holds FROM d""")
def inn_checksum(t):
    number = F.lpad((F.col("c_custkey") * 1000003 % 10000000000).cast("string"), 10, "0")
    return t.customer.select("c_custkey", number.alias("number"), C.tax_number_holds(number).alias("holds"))


@query("""
SELECT c_custkey, c_name AS name, CASE WHEN c_nationkey > 0 THEN lpad(CAST(c_custkey AS VARCHAR), 10, '0') END AS inn, lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS kpp, c_mktsegment AS region FROM customer""")
def counterparty_parse(t):
    key = F.col("c_custkey").cast("string")
    inn = F.when(F.col("c_nationkey") > 0, F.lpad(key, 10, "0")).otherwise(F.lit(""))
    raw = F.concat(F.col("c_name"), F.lit(" | ИНН "), inn, F.lit(" | КПП "), F.lpad(key, 9, "0"), F.lit(" | "), F.col("c_mktsegment"))
    return t.customer.select("c_custkey", C.counterparty(raw).alias("p")).select("c_custkey", "p.*")


@query("""
WITH a AS (SELECT c_custkey, CASE WHEN c_nationkey % 3 = 0 THEN '' ELSE regexp_replace(c_name, '[^0-9]', '', 'g') END AS a, CASE WHEN c_nationkey % 4 = 0 THEN '' WHEN c_nationkey % 4 = 1 THEN '1' ELSE lpad(CAST(c_custkey AS VARCHAR), 9, '0') END AS b FROM customer)
SELECT c_custkey, CASE WHEN a = '' AND b = '' THEN 'both_missing' WHEN a = '' THEN 'llm_missing' WHEN b = '' THEN 'edo_missing' WHEN a = b THEN 'match' ELSE 'mismatch' END AS status FROM a""")
def digits_compare(t):
    nation = F.col("c_nationkey")
    found = F.when(nation % 3 == 0, F.lit(None)).otherwise(F.col("c_name"))
    known = F.when(nation % 4 == 0, F.lit(None)).when(nation % 4 == 1, F.lit("1")).otherwise(F.lpad(F.col("c_custkey").cast("string"), 9, "0"))
    return t.customer.select("c_custkey", C.digits_status(found, known).alias("status"))


@query()
def name_compare(t):
    full = F.concat(F.lit("Общество с ограниченной ответственностью "), F.col("s_name"))
    return t.supplier.select("s_suppkey", C.name_status(F.concat(F.lit("ООО "), F.col("s_name")), F.lit(None).cast("string"), full).alias("status"))


@query("SELECT c_custkey, c_name AS subject, NULL::VARCHAR AS kind, c_mktsegment AS party FROM customer")
def field_parse(t):
    raw = F.concat(F.lit("Предмет: "), F.col("c_name"), F.lit("\nТИП:\nКОНТРАГЕНТ - "), F.col("c_mktsegment"))
    return t.customer.select("c_custkey", T.field(raw, "ПРЕДМЕТ").alias("subject"), T.field(raw, "ТИП").alias("kind"), T.field(raw, "КОНТРАГЕНТ").alias("party"))


@query("SELECT c_custkey, upper(substr(lower(c_mktsegment), 1, 1)) || substr(lower(c_mktsegment), 2) AS kind FROM customer")
def canonical_type(t):
    return t.customer.select("c_custkey", T.canonical_type(F.concat(F.lit("  "), F.col("c_mktsegment"), F.lit(" ")), "Без типа").alias("kind"))


@query()
def joined_letters(t):
    return t.documents.select("doc_id", F.md5(T.joined_single_letters(F.col("text"))).alias("digest"))
