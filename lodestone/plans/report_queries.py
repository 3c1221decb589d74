"""Counts, coverage, pivots, percentiles, listings and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import reports as R
from .catalog import query
from .theme_queries import assigned, CEN, r6


@query("SELECT count(*) AS n, count(*) FILTER (WHERE quality = 1) AS n_good, count(*) FILTER (WHERE toxic = 1) AS n_toxic, count(*) FILTER (WHERE quality IS NULL) AS n_unlabelled, count(*) FILTER (WHERE n_chars < 100) AS n_short, count(*) FILTER (WHERE text IS NULL OR text = '') AS n_empty FROM documents LEFT JOIN labels USING (doc_id)")
def pipeline_stats(t):
    rows = t.documents.join(t.labels, "doc_id", "left")
    q = F.col("quality")
    return R.counted(rows, {"n_good": q == 1, "n_toxic": F.col("toxic") == 1, "n_unlabelled": q.isNull(), "n_short": F.col("n_chars") < 100, "n_empty": F.coalesce("text", F.lit("")) == ""})


@query("SELECT d.source, count(t.doc_id) AS n FROM (SELECT DISTINCT source FROM documents) d LEFT JOIN (SELECT source, doc_id FROM documents JOIN labels USING (doc_id) WHERE toxic = 1) t ON d.source = t.source GROUP BY d.source")
def format_stats(t):
    toxic = t.documents.join(t.labels.filter("toxic = 1"), "doc_id").select("source")
    return R.with_zeros(toxic, t.documents, "source")


@query("SELECT source, lang, count(*) AS n, round(avg(n_chars), 6) AS mean_chars, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY source, lang")
def stats_by_two(t):
    return t.documents.groupBy("source", "lang").agg(F.count("*").alias("n"), r6(F.avg("n_chars")).alias("mean_chars"), F.sum("n_chars").alias("chars"))


@query("SELECT user_id, count(*) AS n FROM events GROUP BY user_id HAVING count(*) >= 20")
def having_count(t):
    return t.events.groupBy("user_id").agg(F.count("*").alias("n")).filter("n >= 20")


@query("SELECT l_shipdate AS day, CAST(sum(CAST(l_returnflag = 'R' AS INTEGER)) AS BIGINT) AS returned, count(*) AS n FROM lineitem GROUP BY l_shipdate HAVING sum(CAST(l_returnflag = 'R' AS INTEGER)) = 0")
def source_only_types(t):
    returned = F.sum((F.col("l_returnflag") == "R").cast("int"))
    return t.lineitem.groupBy(F.col("l_shipdate").alias("day")).agg(returned.alias("returned"), F.count("*").alias("n")).filter("returned = 0")


@query("SELECT count(DISTINCT user_id) AS users, (SELECT count(*) FROM (SELECT DISTINCT user_id, event_type FROM events)) AS pairs, count(*) AS n FROM events")
def distinct_agg(t):
    return t.events.agg(F.count_distinct("user_id").alias("users"), F.count_distinct(F.struct("user_id", "event_type")).alias("pairs"), F.count("*").alias("n"))


@query("SELECT user_id, string_agg(DISTINCT event_type, ', ' ORDER BY event_type) AS kinds FROM events GROUP BY user_id")
def list_agg(t):
    return t.events.groupBy("user_id").agg(R.listed("event_type").alias("kinds"))


@query("WITH n AS (SELECT o_orderpriority, o_orderstatus, count(*) AS c FROM orders GROUP BY ALL) SELECT o_orderpriority, string_agg(o_orderstatus, ', ' ORDER BY c DESC, o_orderstatus) AS listed, CAST(sum(c) AS BIGINT) AS n FROM n GROUP BY o_orderpriority HAVING count(*) > 1")
def ordered_list_agg(t):
    n = t.orders.groupBy("o_orderpriority", "o_orderstatus").agg(F.count("*").alias("c"))
    out = n.groupBy("o_orderpriority").agg(R.listed("o_orderstatus", "c").alias("listed"), F.sum("c").alias("n"), F.count("*").alias("k"))
    return out.filter("k > 1").drop("k")


@query("SELECT count(*) AS n, CAST(sum(quality) AS BIGINT) AS good, round(avg(quality), 6) AS share, max(doc_id) AS last FROM labels")
def corpus_stats(t):
    return t.labels.agg(F.count("*").alias("n"), F.sum("quality").alias("good"), r6(F.avg("quality")).alias("share"), F.max("doc_id").alias("last"))


@query(f"WITH {CEN} SELECT round(count(*) FILTER (WHERE s >= 0.4) / count(*), 6) AS coverage, round(avg(s), 6) AS mean, round(min(s), 6) AS least, round(max(s), 6) AS most FROM best")
def similarity_coverage(t):
    s = F.col("similarity")
    return assigned(t).agg(r6(F.avg((s >= 0.4).cast("int"))).alias("coverage"), r6(F.avg(s)).alias("mean"), r6(F.min(s)).alias("least"), r6(F.max(s)).alias("most"))


_MARKS = [0.2, 0.3, 0.4, 0.5, 0.6]


@query(f"WITH {CEN} SELECT threshold, count(*) FILTER (WHERE s >= threshold) AS n FROM best, (VALUES (0.2), (0.3), (0.4), (0.5), (0.6)) v(threshold) GROUP BY threshold")
def threshold_coverage(t):
    return R.coverage_at(assigned(t), "similarity", _MARKS)


@query("WITH n AS (SELECT source, lang, count(*) AS c FROM documents GROUP BY ALL) SELECT source, CAST(sum(c) AS BIGINT) AS n, string_agg(lang || '=' || c, ', ' ORDER BY c DESC, lang) AS parts FROM n GROUP BY source")
def cluster_parts(t):
    return R.nested_counts(t.documents, "source", "lang")


@query("WITH n AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL) SELECT user_id, event_type, n FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) AS r FROM n) WHERE r = 1")
def top_value(t):
    return R.top_value(t.events, "user_id", "event_type")


@query("SELECT k AS event_user, count(*) FILTER (WHERE s = 1) AS purchases, count(*) FILTER (WHERE s = 2) AS errors, count(*) AS total FROM (SELECT user_id AS k, 1 AS s FROM events WHERE event_type = 'purchase' UNION ALL SELECT user_id, 2 FROM events WHERE event_type = 'error') GROUP BY k")
def type_pivot(t):
    parts = {"purchases": "purchase", "errors": "error"}
    out = R.by_source({k: t.events.filter(F.col("event_type") == v) for k, v in parts.items()}, "user_id")
    return out.withColumnRenamed("user_id", "event_user")


@query("WITH v AS (SELECT source, n_chars, row_number() OVER (PARTITION BY source ORDER BY n_chars) - 1 AS r, count(*) OVER (PARTITION BY source) AS n FROM documents) SELECT source, max(n_chars) FILTER (WHERE r = n // 2) AS med, max(n_chars) FILTER (WHERE r = n * 9 // 10) AS p90 FROM v GROUP BY source")
def nearest_rank(t):
    return R.nearest_ranks(t.documents, "source", "n_chars", {"med": (1, 2), "p90": (9, 10)})


@query("SELECT source, round(quantile_cont(n_chars, 0.1), 6) AS p10, round(quantile_cont(n_chars, 0.5), 6) AS p50, round(quantile_cont(n_chars, 0.9), 6) AS p90 FROM documents GROUP BY source")
def percentiles(t):
    return t.documents.groupBy("source").agg(*(r6(F.percentile("n_chars", p / 100)).alias(f"p{p}") for p in (10, 50, 90)))


@query("WITH u AS (SELECT url FROM pages UNION ALL SELECT url FROM pages WHERE url LIKE '%/en/%') SELECT count(*) AS n, count(*) FILTER (WHERE lower(url) LIKE '%ref=x') AS n_ref, count(*) FILTER (WHERE lower(url) LIKE '%page=2%') AS n_second FROM u")
def suffix_counts(t):
    url = F.lower("url")
    both = t.pages.select("url").unionByName(t.pages.filter(F.contains("url", F.lit("/en/"))).select("url"))
    return R.counted(both, {"n_ref": url.endswith("ref=x"), "n_second": F.contains(url, F.lit("page=2"))})


@query("SELECT lang, round(avg(length(text)), 6) AS mean, min(length(text)) AS least, max(length(text)) AS most FROM documents GROUP BY lang")
def text_lengths(t):
    n = F.length("text").cast("long")
    return t.documents.groupBy("lang").agg(r6(F.avg(n)).alias("mean"), F.min(n).alias("least"), F.max(n).alias("most"))


@query("SELECT source, count(DISTINCT lang) FILTER (WHERE lang <> 'en') AS others, count(*) FILTER (WHERE lang = 'en') AS n_en FROM documents GROUP BY source")
def distinct_without(t):
    return t.documents.groupBy("source").agg(F.count_distinct(F.when(F.col("lang") != "en", F.col("lang"))).alias("others"), F.count_if(F.col("lang") == "en").alias("n_en"))


@query("SELECT c_mktsegment, o_orderstatus, count(*) AS n, count(*) FILTER (WHERE contains(o_orderpriority, 'URGENT')) AS n_urgent, count(*) FILTER (WHERE contains(o_orderpriority, 'LOW')) AS n_low FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL")
def joined_counts(t):
    both = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    p = F.col("o_orderpriority")
    return R.counted(both, {"n_urgent": p.contains("URGENT"), "n_low": p.contains("LOW")}, ["c_mktsegment", "o_orderstatus"])


@query("SELECT label, share, c_low - (SELECT avg(label) FROM embeddings WHERE label < 5) AS above FROM (SELECT label, round(avg(CAST(label = -1 AS INTEGER)), 6) AS share, avg(label) AS c_low FROM embeddings GROUP BY label)")
def noise_share(t):
    low = t.embeddings.filter("label < 5").agg(F.avg("label").alias("low"))
    per = t.embeddings.groupBy("label").agg(r6(F.avg((F.col("label") == -1).cast("int"))).alias("share"), F.avg("label").alias("c"))
    return per.join(F.broadcast(low)).select("label", "share", (F.col("c") - F.col("low")).alias("above"))


@query()
def density_cells(t):
    return R.histogram_2d(t.lineitem, "l_quantity", "l_extendedprice", 20)


@query("SELECT n_name, r_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL")
def three_way_join(t):
    c = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return c.groupBy("n_name", "r_name").agg(F.count("*").alias("n"))


@query("SELECT c_mktsegment, count(*) AS n, max(n_name) AS last_nation FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey = 1) ON c_nationkey = n_nationkey GROUP BY c_mktsegment")
def left_join_agg(t):
    dim = t.nation.filter("n_regionkey = 1")
    out = t.customer.join(dim, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return out.groupBy("c_mktsegment").agg(F.count("*").alias("n"), F.max("n_name").alias("last_nation"))


@query("SELECT d.doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def anti_join_pending(t):
    from ..operators.changes import pending

    return pending(t.documents, t.labels, ["doc_id"]).select("doc_id")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0)")
def null_aware_not_in(t):
    from ..operators.gates import not_in

    return not_in(t.documents.select("doc_id"), "doc_id", t.labels.filter("quality = 0").select("doc_id"))


@query("SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def semi_join(t):
    return t.documents.join(t.labels.filter("toxic = 1"), "doc_id", "left_semi").select("doc_id", "source")


@query("SELECT count(*) AS n, count(*) FILTER (WHERE a.label <> b.label) AS moved FROM embeddings a JOIN embeddings b ON a.vec_id = b.vec_id + 1")
def self_join(t):
    a = t.embeddings.select("vec_id", F.col("label").alias("a"))
    b = t.embeddings.select((F.col("vec_id") + 1).alias("vec_id"), F.col("label").alias("b"))
    return a.join(b, "vec_id").agg(F.count("*").alias("n"), F.count_if(F.col("a") != F.col("b")).alias("moved"))


@query("SELECT k AS host, count(*) AS n, count(doc_id) AS n_known FROM (SELECT split_part(regexp_extract(url, '://([^/]+)', 1), '.', 1) AS k, page_id FROM pages) LEFT JOIN labels ON page_id = doc_id GROUP BY k")
def derived_key_join(t):
    host = F.substring_index(F.regexp_extract("url", "://([^/]+)", 1), ".", 1)
    keyed = t.pages.select(host.alias("host"), F.col("page_id").alias("doc_id")).join(t.labels.select("doc_id", F.lit(1).alias("hit")), "doc_id", "left")
    return keyed.groupBy("host").agg(F.count("*").alias("n"), F.count("hit").alias("n_known"))


@query("SELECT c_custkey, (SELECT max(o_totalprice) FROM orders WHERE o_custkey = c_custkey) AS largest FROM customer")
def scalar_subquery(t):
    largest = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_totalprice").alias("largest"))
    return t.customer.select("c_custkey").join(largest, "c_custkey", "left")


@query("WITH n AS (SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY ALL) SELECT c_nationkey, c_mktsegment, n, r AS rank FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY n DESC, c_mktsegment) AS r FROM n) WHERE r <= 3")
def top_types_per_theme(t):
    from ..operators.sampling import capped

    n = t.customer.groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").alias("n"))
    from pyspark.sql import Window

    out = capped(n, "c_nationkey", 3, F.desc("n"), "c_mktsegment")
    return out.withColumn("rank", F.row_number().over(Window.partitionBy("c_nationkey").orderBy(F.desc("n"), "c_mktsegment")))
