"""Corpus pipeline: documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes what a stage returns and reads
it again as the next one's docs, so a lost executor costs part of a stage at most. All stages but the last
return the columns of documents; their decisions take effect: what a stage rejects is gone for the next.

- quality rules: documents that a rule rejects go;
- line dedup: later copies of repeated line runs go from the texts, and documents left without a word go;
- n-gram Jaccard join, five words and 0.8: of each group the document with the smallest id stays;
- benchmark decontamination: documents that hold a benchmark item go;
- best-fit packing: the pieces of what is left, each with its place in a sequence.

Rows with a null id or text are judged as the operators say; rows that share a doc_id stand or fall together
in the third stage. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm import decontaminate, line_dedup, ngram_join, packing, quality
from lodestone.llm.common import Scratch, read

#: No SQL: the near-duplicate, SimHash and packing stages can't be put in it. Tested against brute force.
ORACLE_SQL = None
#: The near-duplicate stage's shingles and threshold.
WORDS, PERCENT = 5, 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = docs.select(F.struct("*").alias("document"), "text")
    return quality.judge(rows).filter("kept").select("document.*")


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup(docs, Scratch(spark, "pipeline-lines"))
    out = out.filter("n_deleted = 0 or text <> ''")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = ngram_join.join(docs, Scratch(spark, "pipeline-ngrams"), WORDS, PERCENT, count_links=False)
    gone = found.filter("component_id < doc_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"), Scratch(spark, "pipeline-benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(docs.select("doc_id", "text")), Scratch(spark, "pipeline-packing"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", dedup_lines),
    ("ngram_join", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, one after another."""
    scratch, docs, before = Scratch(spark, "pipeline"), read(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = scratch.table(name, stage(spark, docs, sf_dir))
        if before:
            scratch.drop(before)
        before = name
    return docs
