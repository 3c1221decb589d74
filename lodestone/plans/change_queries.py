"""Upserts, updates, resets, snapshots, map merges and counts by event time."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import changes as K
from ..streaming import incremental
from .catalog import query


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1")
def upsert_latest(t):
    rows = t.events.select("user_id", "event_id", "event_type", F.struct("ts", "event_id").alias("at"))
    return K.latest(rows, ["user_id"], "at").drop("at")


@query("SELECT c_custkey, c_nationkey, c_acctbal FROM customer WHERE c_acctbal >= 0 AND c_nationkey > 5 UNION ALL SELECT c_custkey, 99, c_acctbal + 1 FROM customer WHERE c_nationkey <= 5")
def upsert(t):
    rows = t.customer.select("c_custkey", "c_nationkey", "c_acctbal")
    new = rows.filter("c_nationkey <= 5").withColumns({"c_nationkey": F.lit(99), "c_acctbal": F.col("c_acctbal") + 1})
    return K.upsert(rows.filter("c_acctbal >= 0"), new, ["c_custkey"])


@query("SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN 'old' ELSE 'new' END AS origin FROM customer")
def insert_missing(t):
    key = t.customer.select("c_custkey", "c_acctbal")
    old = key.filter("c_acctbal >= 0").select("c_custkey", F.lit("old").alias("origin"))
    return K.insert_missing(old, key.select("c_custkey", F.lit("new").alias("origin")), ["c_custkey"])


@query("SELECT c_custkey, CASE WHEN c_nationkey < 10 THEN 'MACHINERY' ELSE c_mktsegment END AS c_mktsegment, c_nationkey < 10 AND c_mktsegment <> 'MACHINERY' AS changed FROM customer")
def update_changed(t):
    old = t.customer.select("c_custkey", "c_mktsegment")
    new = t.customer.filter("c_nationkey < 10").select("c_custkey", F.lit("MACHINERY").alias("c_mktsegment"))
    return K.update(old, new, ["c_custkey"], ["c_mktsegment"], only_changed=True)


@query("SELECT doc_id, CASE WHEN source = 'src_0' OR lang = 'de' THEN NULL ELSE n_chars END AS n_chars, NOT (source = 'src_0' OR lang = 'de') AS done FROM documents")
def rollback_format(t):
    rows = t.documents.select("doc_id", "source", "lang", "n_chars", F.lit(True).alias("done"))
    hit = (F.col("source") == "src_0") | (F.col("lang") == "de")
    return K.cleared(rows, hit, ["n_chars"], ["done"]).select("doc_id", "n_chars", "done")


@query("SELECT vec_id FROM embeddings WHERE vec_id NOT IN (SELECT doc_id FROM documents WHERE lang = 'fr')")
def delete_vectors(t):
    owners = t.documents.filter("lang = 'fr'").select(F.col("doc_id").alias("vec_id"))
    return K.delete_of(t.embeddings.select("vec_id"), owners, ["vec_id"])


@query("SELECT doc_id, doc_id IN (SELECT vec_id FROM embeddings) AS embedded FROM documents")
def embedded_flag(t):
    docs = t.documents.select("doc_id", F.lit(False).alias("embedded"))
    return K.flagged(docs, t.embeddings.select(F.col("vec_id").alias("doc_id")), ["doc_id"], "embedded")


@query("SELECT doc_id, quality, source FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL AND text IS NOT NULL")
def gold_snapshot(t):
    rows = t.documents.join(t.labels, "doc_id", "left").select("doc_id", "quality", "source", "text")
    return K.snapshot(rows, ["doc_id"], ["quality", "text"]).drop("text")


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS VARCHAR) AS k, event_type AS kind FROM events")
def registry_merge_json(t):
    left = F.from_json("props", "map<string,string>")
    merged = K.merged_maps(left, F.create_map(F.lit("kind"), F.col("event_type")))
    return t.events.select("event_id", merged["k"].alias("k"), merged["kind"].alias("kind"))


@query("SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def event_increment(t):
    return incremental.counts(t.events, "ts", "event_type")


@query("SELECT p_partkey, CASE WHEN r = 1 THEN f ELSE p_type || '_' || (r - 1) || '.txt' END AS unique_name FROM (SELECT p_partkey, p_type, p_type || '.txt' AS f, row_number() OVER (PARTITION BY p_brand, p_type ORDER BY p_partkey) AS r FROM part)")
def unique_names(t):
    files = t.part.select("p_partkey", "p_brand", F.concat("p_type", F.lit(".txt")).alias("f"))
    return K.unique_names(files, "p_brand", "f", "p_partkey").select("p_partkey", "unique_name")
