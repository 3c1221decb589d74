"""Queries that write files of the given tables, read them back by a source, and take their texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import extract
from ..operators.graph import shared_folder
from ..sources import archives
from .catalog import Tables, query

_HEAD = '<office:document xmlns:office="urn:oasis:names:tc:opendocument:xmlns:office:1.0" xmlns:text="urn:oasis:names:tc:opendocument:xmlns:text:1.0"><office:body><office:text>'


def _written(t: Tables, rows: DataFrame) -> str:
    folder = shared_folder(t.spark)
    archives.write(rows, folder)
    return folder


def _open_document(text: Column) -> Column:
    """A flat OpenDocument file of a text: a paragraph for each line, without the signs that XML can't hold."""
    plain = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x00-\x08\x0B-\x1F\x{FFFE}\x{FFFF}]", "")
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        plain = F.replace(plain, F.lit(sign), F.lit(name))
    lines = F.transform(F.split(plain, "\n"), lambda x: F.concat(F.lit("<text:p>"), x, F.lit("</text:p>")))
    return F.concat(F.lit(_HEAD), F.array_join(lines, ""), F.lit("</office:text></office:body></office:document>")).cast("binary")


@query(
    """
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n_bytes, sha256(coalesce(html, '')) AS digest
    FROM pages
    """
)
def archive_members(t: Tables) -> DataFrame:
    folder = _written(t, t.pages.select(F.col("page_id").cast("string").alias("member"), F.col("html").alias("content")))
    read = archives.members(t.spark, folder, partition_bytes=1 << 20)
    return read.select(F.col("member").cast("long").alias("page_id"), F.col("length").alias("n_bytes"), F.sha2("content", 256).alias("digest"))


@query(
    r"""
    SELECT page_id, trim(regexp_replace(regexp_replace(coalesce(html, ''), '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')) AS text
    FROM pages
    """
)
def archive_texts(t: Tables) -> DataFrame:
    """Each page as the text of its own member; `archives.texts` joins those of an archive."""
    folder = _written(t, t.pages.select(F.concat(F.col("page_id").cast("string"), F.lit(".xml")).alias("member"), F.col("html").alias("content")))
    own = archives.members(t.spark, folder, "*.xml").withColumn("archive", F.col("member"))
    return archives.texts(own).select(F.regexp_extract("archive", r"^(\d+)", 1).cast("long").alias("page_id"), "text")


@query(
    r"""
    WITH l AS (
        SELECT doc_id, list_transform(string_split(regexp_replace(coalesce(text, ''), '[\x00-\x08\x0B-\x1F]', '', 'g'), chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')) AS l
        FROM documents
    )
    SELECT doc_id, left(nullif(array_to_string(list_filter(l, lambda x: x <> ''), chr(10)), ''), 8000) AS text,
        CASE WHEN len(list_filter(l, lambda x: x <> '')) = 0 THEN 'no text' END AS error
    FROM l
    """
)
def open_document_text(t: Tables) -> DataFrame:
    read = t.documents.select("doc_id", extract.open_document_text(_open_document(F.col("text"))).alias("r"))
    return read.select("doc_id", "r.text", "r.error")


@query(
    r"""
    WITH l AS (
        SELECT doc_id, lang, text,
            list_transform(string_split(regexp_replace(text, '[\x00-\x08\x0B-\x1F]', '', 'g'), chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')) AS l,
            list_transform(string_split(replace(text, chr(13) || chr(10), chr(10)), chr(10)),
                lambda x: array_to_string(list_filter(list_transform(string_split(x, ','), lambda c: trim(c)), lambda c: c <> ''), ' | ')) AS rows
        FROM documents
    )
    SELECT doc_id,
        CASE WHEN lang = 'en' THEN left(nullif(array_to_string(list_filter(l, lambda x: x <> ''), chr(10)), ''), 8000)
            WHEN lang = 'de' THEN array_to_string(list_filter(rows, lambda x: x <> ''), chr(10))
            WHEN lang = 'fr' THEN regexp_replace(text, '^\s+|\s+$', '', 'g') END AS text,
        CASE WHEN text IS NULL AND lang IN ('en', 'de', 'fr') THEN 'no content'
            WHEN lang = 'en' AND len(list_filter(l, lambda x: x <> '')) = 0 THEN 'no text'
            WHEN lang IS NULL OR lang NOT IN ('en', 'de', 'fr') THEN 'Unknown format: .bin' END AS error
    FROM l
    """
)
def extracted_texts(t: Tables) -> DataFrame:
    """Documents as files whose kind follows their language, read again by the reader of each."""
    lang = F.col("lang")
    end = F.when(lang == "en", ".fodt").when(lang == "de", ".csv").when(lang == "fr", ".txt").otherwise(".bin")
    content = F.when(F.col("text").isNotNull(), F.when(lang == "en", _open_document(F.col("text"))).otherwise(F.col("text").cast("binary")))
    files = t.documents.select("doc_id", F.concat(F.col("doc_id").cast("string"), end).alias("path"), content.alias("content"))
    return extract.extracted(files, kind=F.lit(None).cast("string")).select("doc_id", "text", "error")
