"""The registered queries of the training-data operators, and SQL for those that SQL expresses."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, dual_tree, license_scan, line_dedup, ngram_join, packing, pii, quality, resharding, token_shards, vector_packing, warc, whitening
from .common import Scratch, read


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(read(spark, sf_dir, "documents").select("doc_id", "text"), Scratch(spark, "ngrams"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "warc")
    out = scratch.path("archives")
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    return warc.read(warc.write(pages, out, scratch), out)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(read(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), Scratch(spark, "benchmark"))


def op5_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "tokens")
    out = scratch.path("shards")
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return token_shards.read(token_shards.write(docs, out, scratch), out)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(read(spark, sf_dir, "documents").select("doc_id", "text"), Scratch(spark, "pii"))
    spans = F.col("spans")
    n = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.sha2(pii.listed(spans, tuple(pii.PATTERNS)).cast("binary"), 256)
    clean = F.sha2(pii.sanitised(F.col("text"), spans).cast("binary"), 256)
    return found.select(
        "doc_id", *(n(k) for k in pii.PATTERNS), base.alias("base_sha256"), pii.listed(spans).alias("spans"), n("secret"), n("term"),
        F.size("spans").cast("long").alias("n_spans"), clean.alias("sanitised_sha256"),
    )


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    placed = packing.pack(packing.pieces(docs), Scratch(spark, "packing"))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "least_sequences")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup(docs, Scratch(spark, "lines")).select("doc_id", "text", "n_lines", "n_deleted")


SHARDS = 16


def op9_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "shards")
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    # The old layout: a source's documents lie together, so the shards are as uneven as the sources.
    old = docs.select("doc_id", "text", F.pmod(F.xxhash64("source"), F.lit(SHARDS)).cast("int").alias("old_shard"))
    written, _ = resharding.reshard(
        old, scratch.path("shards"), scratch, id_column="doc_id", text_column="text", old_shard="old_shard", shards=SHARDS
    )
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return written.select(
        "doc_id", (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"), F.lit("bytes").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "moved",
    )


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


DIM, CLUSTERS, ROUNDS = 64, 16, 3


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    vector = F.col("embedding")
    rows = read(spark, sf_dir, "embeddings").filter(dual_tree.usable(vector, DIM))
    found = dual_tree.cluster(rows.select(F.col("vec_id").alias("id"), dual_tree.quantised(vector, 64).alias("x")), Scratch(spark, "clusters"), DIM, CLUSTERS, ROUNDS)
    return found.withColumnRenamed("id", "vec_id")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings").filter(whitening.usable(F.col("embedding")))
    return whitening.whiten(rows.select("vec_id", whitening.entries(F.col("embedding")).alias("x")), Scratch(spark, "whitening"))


def op13_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A plain document has no prompt: all its ids bear loss.
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return vector_packing.pack(docs, Scratch(spark, "vectors"))


_ALL = (
    op1_ngram_join, op2_warc, op3_license_scan, op4_decontamination, op5_token_shards, op6_pii, op7_packing, op8_line_dedup, op9_resharding, op10_quality_rules,
    op11_centroid_clustering, op12_whitening, op13_vector_packing,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _ALL}


_STOP = ", ".join(f"'{w}'" for w in sorted({w for ws in quality.STOP_WORDS.values() for w in ws}))

_QUALITY = rf"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
wins AS (
  SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 4), ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM wins) WHERE c > 1),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest(range(0, 5)) AS k) GROUP BY doc_id),
m AS (
  SELECT w.doc_id, len(ws) AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(ls) AS n_lines,
         len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
         len(list_filter(ws, lambda x: lower(x) IN ({_STOP}))) AS n_stop_words
  FROM w LEFT JOIN rep ON w.doc_id = rep.doc_id),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND word_chars / n_words BETWEEN 2.0 AND 16.0 AND n_symbols / n_words <= 0.10
       AND n_dup_lines / n_lines <= 0.50 AND n_stop_words / n_words >= 0.02 AS kept
FROM b
"""


def _lloyd() -> str:
    """The rounds written out: a_i assigns by the centroids c_i, and c_(i + 1) are their exact floored means."""
    assign = """a{i} AS (
  SELECT r, min(d * 64 + k) % 64 AS k, min(d) AS d
  FROM (SELECT v.r, c.k, list_sum(list_transform(range(1, 65), lambda j: (v.x[j] - c.c[j]) * (v.x[j] - c.c[j])))::HUGEINT AS d FROM v, c{i} c) GROUP BY r)"""
    mean = """m{n} AS (
  SELECT k, list(q ORDER BY j) AS c
  FROM (SELECT k, j, (s - (s % n + n) % n) // n AS q
        FROM (SELECT a.k, t.j, sum(v.x[t.j])::HUGEINT AS s, count(*)::HUGEINT AS n FROM a{i} a JOIN v USING (r), range(1, 65) t(j) GROUP BY ALL)) GROUP BY k),
c{n} AS (SELECT c.k, coalesce(m.c, c.c) AS c FROM c{i} c LEFT JOIN m{n} m ON c.k = m.k)"""
    steps = [part for i in range(ROUNDS) for part in (assign.format(i=i), mean.format(i=i, n=i + 1))]
    return ",\n".join([*steps, assign.format(i=ROUNDS)])


_CLUSTERING = f"""
WITH w AS (
  SELECT vec_id, embedding FROM embeddings
  WHERE len(embedding) = {DIM} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 64) AS HUGEINT)) AS x FROM w),
c0 AS (SELECT row_number() OVER (ORDER BY h, x) - 1 AS k, x AS c FROM (SELECT sha256('1:' || coalesce(vec_id::VARCHAR, '')) AS h, x FROM v) ORDER BY h, x LIMIT {CLUSTERS}),
{_lloyd()}
SELECT vec_id, CAST(a.k AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance,
       CAST(sum(a.d) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.c, ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN v USING (r) JOIN c{ROUNDS} c ON c.k = a.k
"""


def oracle_sql() -> dict[str, str]:
    return {"op10_quality_rules": _QUALITY, "op11_centroid_clustering": _CLUSTERING}
