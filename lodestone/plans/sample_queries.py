"""Caps, samples, budgets, runs, ranks, shards."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import sampling as S
from .catalog import query


def _order(key: str) -> str:
    return f"md5('42:' || {key})"


@query("SELECT vec_id, label FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS r FROM embeddings) WHERE r <= 20")
def cap_per_theme(t):
    return S.capped(t.embeddings, "label", 20, "vec_id").select("vec_id", "label")


@query(f"SELECT doc_id FROM documents ORDER BY {_order('doc_id')}, doc_id LIMIT 100")
def seeded_sample(t):
    return S.sample(t.documents.select("doc_id"), "doc_id", 100)


@query(f"SELECT doc_id, source FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY {_order('doc_id')}, doc_id) AS r FROM documents) WHERE r <= 5")
def stratified_sample(t):
    return S.stratified(t.documents.select("doc_id", "source"), "source", "doc_id", 5)


@query("SELECT doc_id FROM documents WHERE doc_id % 7 = 3")
def shard_select(t):
    return S.shard(t.documents.select("doc_id"), "doc_id", 7, 3)


@query(f"SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY {_order('doc_id')}, doc_id) <= (SELECT count(*) FROM documents) // 2 THEN 'train' ELSE 'test' END AS part FROM documents")
def train_test_halves(t):
    return S.halves(t.documents.select("doc_id"), "doc_id")


@query("SELECT source, doc_id FROM (SELECT source, doc_id, coalesce(sum(n_chars) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM documents) WHERE s < 20000")
def running_budget(t):
    return S.within_budget(t.documents.select("source", "doc_id", "n_chars"), "source", "n_chars", 20000, "doc_id").select("source", "doc_id")


@query("""
WITH m AS (SELECT *, CASE WHEN event_type IS DISTINCT FROM lag(event_type) OVER w THEN 1 ELSE 0 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
r AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM m)
SELECT user_id, CAST(run AS BIGINT) AS run, event_type, count(*) AS length FROM r GROUP BY ALL""")
def run_compression(t):
    return S.runs(t.events, "user_id", ["ts", "event_id"], "event_type")


@query("WITH n AS (SELECT source, count(*) AS c, sum(n_chars) AS k FROM documents GROUP BY source), o AS (SELECT source AS name, CAST(k AS BIGINT) AS n, row_number() OVER (ORDER BY k DESC, source) AS r FROM n) SELECT CASE WHEN r <= 5 THEN name ELSE 'rest' END AS source, CAST(sum(n) AS BIGINT) AS n FROM o GROUP BY 1")
def top_or_rest(t):
    return S.top_or_rest(t.documents.groupBy("source").agg(F.sum("n_chars").alias("n")), "source", 5)


@query("SELECT label, c FROM (SELECT label, count(*) AS c FROM embeddings GROUP BY label) ORDER BY (label = -1), c DESC, label LIMIT 15")
def noise_last(t):
    n = t.embeddings.groupBy("label").agg(F.count("*").alias("c"))
    return n.orderBy(F.col("label") == -1, F.desc("c"), "label").limit(15)


@query("SELECT o_custkey, o_orderkey, rank() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC) AS place FROM orders")
def label_rank(t):
    place = F.rank().over(Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice")))
    return t.orders.select("o_custkey", "o_orderkey", place.alias("place"))


@query("SELECT o_orderkey, count(*) OVER (PARTITION BY o_custkey) = 1 AS single FROM orders WHERE o_orderstatus = 'F'")
def singleton_status(t):
    kept = t.orders.filter("o_orderstatus = 'F'")
    n = kept.groupBy("o_custkey").agg((F.count("*") == 1).alias("single"))
    return kept.join(n, "o_custkey").select("o_orderkey", "single")


@query("SELECT DISTINCT p_type, dense_rank() OVER (ORDER BY p_type) - 1 AS number FROM part")
def dense_renumber(t):
    # Numbers of the distinct values: the window has a row a value, not a row a part.
    number = F.dense_rank().over(Window.orderBy("p_type")) - 1
    return t.part.select("p_type").distinct().withColumn("number", number.cast("long"))


@query("SELECT conv_id, string_agg(CASE WHEN n > 1 THEN role || ' (×' || n || ')' ELSE role END, ', ' ORDER BY run) AS roles FROM (SELECT conv_id, run, role, count(*) AS n FROM (SELECT *, sum(new) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS run FROM (SELECT *, CASE WHEN role IS DISTINCT FROM lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) THEN 1 ELSE 0 END AS new FROM conversations)) GROUP BY ALL) GROUP BY conv_id")
def compressed_roles(t):
    roles = F.transform(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))), lambda x: x["role"])
    per = t.conversations.groupBy("conv_id").agg(roles.alias("r"))
    return per.select("conv_id", F.array_join(T.compressed_runs(F.col("r")), ", ").alias("roles"))
