"""Every registered training-data query on the smallest tables and on awkward ones; op10 against its SQL."""

import os
import zlib

import duckdb
import pytest

import corpus_pipeline
from lodestone.llm import queries

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
COLUMNS = {
    "op1_ngram_join": ("doc_id", "n_shingles", "component_id"),
    "op2_warc": ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"),
    "op3_license_scan": ("doc_id", "license_id"),
    "op4_decontamination": ("doc_id", "item_id", "similarity"),
    "op5_token_shards": ("doc_id", "start", "n_tokens", "ids_crc32"),
    "op6_pii": ("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"),
    "op7_packing": ("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"),
    "op8_line_dedup": ("doc_id", "n_deleted"),
    "op9_resharding": ("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"),
    "op10_quality_rules": ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"),
}
ONE_EACH = ("op1_ngram_join", "op5_token_shards", "op6_pii", "op8_line_dedup", "op9_resharding", "op10_quality_rules")


@pytest.fixture(scope="module")
def awkward(spark, tmp_path_factory):
    """Null and repeated ids, null, empty and long texts, repeated rows, columns with the names of results."""
    folder = str(tmp_path_factory.mktemp("awkward"))
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    texts = [None, "", " \n ", "one", long, long, "a b c d e f g h i j k " * 3, "x\ny\nx\ny", "a@b.c +1 555 123 4567 10.0.0.1"]
    rows = [(i, t, "en", "s", len(t or ""), 5, "k") for i, t in enumerate(texts)]
    rows += [(None, "null id", None, None, None, None, None), (None, "null id", None, None, None, None, None), rows[6], rows[6]]
    schema = "doc_id long, text string, lang string, source string, n_chars long, size int, kept string"
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/documents.parquet")
    pages = [(1, "u", "h" * 300), (1, "u", "h" * 300), (None, None, None), (3, "v", ""), (4, "w", "h" * 300)]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{folder}/pages.parquet")
    spark.createDataFrame([(1, "a b c d e f g h i j k a b c"), (None, None), (3, "")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


@pytest.mark.parametrize("name", COLUMNS)
def test_query_of_awkward_tables(spark, awkward, name):
    out = queries.queries()[name](spark, awkward)
    rows = out.collect()
    assert set(COLUMNS[name]) <= set(out.columns)
    if name in ONE_EACH:
        assert len(rows) == 13
    if name == "op2_warc":
        assert len(rows) == 5


def test_pipeline_of_awkward_tables(spark, awkward):
    # Null ids and short texts are rejected by the rules, and repeated ones hold too many repeated words.
    assert corpus_pipeline.run(spark, awkward).collect() == []


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", ["op3_license_scan", "op4_decontamination", "op9_resharding"])
def test_query_of_the_smallest_tables(spark, name):
    rows = queries.queries()[name](spark, FOLDER).collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    assert rows and {r["doc_id"] for r in rows} <= docs.keys()
    if name == "op9_resharding":
        assert len(rows) == len(docs)
        places = {}
        for r in rows:
            raw = (docs[r["doc_id"]] or "").encode()
            assert (r["size"], r["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw)) and 0 <= r["shard"] < 16
            places.setdefault(r["shard"], []).append(r["slot"])
        assert all(sorted(s) == list(range(len(s))) for s in places.values())


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_quality_rules_are_their_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    found = con.execute(queries.oracle_sql()["op10_quality_rules"])
    names = [c[0] for c in found.description]
    want = sorted(found.fetchall())
    got = queries.queries()["op10_quality_rules"](spark, FOLDER)
    assert sorted(tuple(r[n] for n in names) for r in got.collect()) == want


def test_a_filter_on_the_verdict_copies_no_measure(spark):
    from pyspark.sql import functions as F

    from lodestone.llm import quality

    docs = spark.createDataFrame([(1, "some text", "s")], "doc_id long, text string, kept string")
    judged = quality.judge(docs.select(F.struct("*").alias("document"), "text"))
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert plan(judged.filter("kept").select("document.*")).count("xxhash64") == plan(judged).count("xxhash64")
