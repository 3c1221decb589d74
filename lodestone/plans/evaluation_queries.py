"""More reports and evaluation: groups of groups, crosstabs, leave-one-out by group, validity, runs and passes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import vectors as V
from ..operators import evaluation as E
from ..operators import metrics as M
from .catalog import query
from .theme_queries import CEN, assigned, r6


@query("SELECT n_name, count(*) AS n, round(avg(c_acctbal), 6) AS mean, string_agg(DISTINCT c_mktsegment, ', ' ORDER BY c_mktsegment) AS words FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name ORDER BY n DESC, n_name")
def theme_stats(t):
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    words = F.array_join(F.array_sort(F.collect_set("c_mktsegment")), ", ")
    return rows.groupBy("n_name").agg(F.count("*").alias("n"), r6(F.avg("c_acctbal")).alias("mean"), words.alias("words")).orderBy(F.desc("n"), "n_name")


@query("SELECT p_brand, count(*) AS clusters, round(avg(n), 6) AS mean, max(n) AS most, min(n) AS least FROM (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY ALL) GROUP BY p_brand")
def name_groups(t):
    n = t.part.groupBy("p_brand", "p_type").agg(F.count("*").alias("n"))
    return n.groupBy("p_brand").agg(F.count("*").alias("clusters"), r6(F.avg("n")).alias("mean"), F.max("n").alias("most"), F.min("n").alias("least"))


@query("WITH n AS (SELECT p_size, p_name, count(*) AS n FROM part GROUP BY ALL) SELECT p_size, (list(p_name ORDER BY n DESC, p_name))[1] AS name, CAST(sum(n) AS BIGINT) AS members, count(*) > 1 AS family FROM n GROUP BY p_size")
def named_groups(t):
    n = t.part.groupBy("p_size", "p_name").agg(F.count("*").alias("n"))
    first = F.min(F.struct((-F.col("n")).alias("o"), F.col("p_name").alias("p")))
    return n.groupBy("p_size").agg(first.alias("f"), F.sum("n").alias("members"), (F.count("*") > 1).alias("family")).select("p_size", F.col("f.p").alias("name"), "members", "family")


@query("SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS f, count(*) FILTER (WHERE o_orderstatus = 'O') AS o, count(*) FILTER (WHERE o_orderstatus = 'P') AS p FROM orders GROUP BY o_orderpriority")
def crosstab(t):
    out = t.orders.groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).agg(F.count(F.lit(1))).fillna(0)
    return out.select("o_orderpriority", *(F.col(c).alias(c.lower()) for c in "FOP"))


@query("WITH r AS (SELECT s AS seed, label AS a, CASE WHEN (vec_id * s) % 7 < 5 THEN label ELSE 0 END AS b FROM embeddings, range(1, 6) t(s)), x AS (SELECT seed, avg(CAST(a = b AS INTEGER)) AS v FROM r GROUP BY seed) SELECT round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std, round(min(v), 6) AS least, round(max(v), 6) AS most, round(max(v) - min(v), 6) AS spread FROM x")
def seed_spread(t):
    rows = t.embeddings.select("vec_id", "label", F.explode(F.sequence(F.lit(1), F.lit(5))).alias("seed"))
    same = F.when((F.col("vec_id") * F.col("seed")) % 7 < 5, F.col("label")).otherwise(0) == F.col("label")
    v = rows.groupBy("seed").agg(F.avg(same.cast("int")).alias("v"))
    return v.agg(r6(F.avg("v")).alias("mean"), r6(F.stddev_pop("v")).alias("std"), r6(F.min("v")).alias("least"), r6(F.max("v")).alias("most"), r6(F.max("v") - F.min("v")).alias("spread"))


@query("SELECT l_returnflag AS engine, metric, round(avg(v), 6) AS mean FROM (SELECT l_returnflag, unnest(['quantity', 'discount', 'tax']) AS metric, unnest([l_quantity, l_discount, l_tax]) AS v FROM lineitem) GROUP BY ALL")
def engine_means(t):
    named = F.create_map(*(x for c in ("quantity", "discount", "tax") for x in (F.lit(c), F.col(f"l_{c}"))))
    return t.lineitem.select(F.col("l_returnflag").alias("engine"), F.explode(named).alias("metric", "v")).groupBy("engine", "metric").agg(r6(F.avg("v")).alias("mean"))


@query("SELECT o_custkey, round(sum(o_totalprice), 2) AS total, count(*) AS n FROM orders GROUP BY o_custkey ORDER BY total DESC, o_custkey LIMIT 15")
def group_sums(t):
    return t.orders.groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("total"), F.count("*").alias("n")).orderBy(F.desc("total"), "o_custkey").limit(15)


@query("SELECT source, count(*) AS n FROM (SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)) GROUP BY source ORDER BY 2 DESC")
def gold_counts(t):
    return t.documents.join(t.labels.filter("quality = 1"), "doc_id", "left_semi").groupBy("source").agg(F.count("*").alias("n")).orderBy(F.desc("n"))


@query("WITH r AS (SELECT l_linestatus AS run, avg(CAST(l_returnflag = 'R' AS INTEGER)) AS corrected, avg(CAST(l_discount < 0.03 AS INTEGER)) AS low, avg(l_discount) AS confidence FROM lineitem GROUP BY 1), f AS (SELECT * FROM r WHERE run = 'F'), o AS (SELECT * FROM r WHERE run = 'O') SELECT round(f.corrected, 6) AS corrected_F, round(f.low, 6) AS low_F, round(f.confidence, 6) AS confidence_F, round(o.corrected, 6) AS corrected_O, round(o.low, 6) AS low_O, round(o.confidence, 6) AS confidence_O, round(o.corrected - f.corrected, 6) AS corrected_delta, round(o.low - f.low, 6) AS low_delta, round(o.confidence - f.confidence, 6) AS confidence_delta FROM f, o")
def run_difference(t):
    out = E.run_difference(t.lineitem, "l_linestatus", "F", "O", F.col("l_returnflag") == "R", "l_discount", 0.03)
    return out.select(*(r6(c).alias(c) for c in out.columns))


_GROUPED = """
WITH u AS (SELECT vec_id, label, vec_id % 40 AS g, list_transform(CAST(embedding AS DOUBLE[]), lambda x: x / sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])))) AS v FROM embeddings),
p AS (SELECT label, g, i, sum(v[i]) AS s, count(*) AS n FROM u, range(1, 65) t(i) WHERE label <> -1 GROUP BY ALL),
c AS (SELECT label, i, sum(s) AS s, sum(n) AS n FROM p GROUP BY ALL),
gs AS (SELECT DISTINCT g FROM u),
d AS (SELECT gs.g, c.label, list(c.s - coalesce(p.s, 0) ORDER BY c.i) AS v, max(c.n - coalesce(p.n, 0)) AS n FROM gs CROSS JOIN c LEFT JOIN p ON p.g = gs.g AND p.label = c.label AND p.i = c.i GROUP BY ALL),
s AS (SELECT u.vec_id, u.label AS own, d.label, CASE WHEN d.n > 0 THEN list_cosine_similarity(u.v, d.v) ELSE -2 END AS s FROM u JOIN d USING (g) WHERE u.label <> -1)
SELECT vec_id, own AS label, round(max(s) FILTER (WHERE label = own), 6) AS own, round(max(s) FILTER (WHERE label <> own), 6) AS best_other FROM s GROUP BY vec_id, own
"""


@query(_GROUPED)
def leave_group_out(t):
    rows = t.embeddings.withColumn("g", F.col("vec_id") % 40)
    return E.leave_group_out(rows, "vec_id", "label", "g").select("vec_id", "label", r6("own").alias("own"), r6("best_other").alias("best_other"))


def _three_models(t):
    every = assigned(t).select("vec_id", "label", "similarity", (F.col("assigned_theme") == F.col("label")).alias("correct"))
    return every.select("vec_id", F.explode(F.array(*(F.struct(F.lit(m).alias("model"), (F.col("similarity") - d).alias("s"), F.col("correct")) for m, d in (("a", 0.0), ("b", 0.05), ("c", 0.1))))).alias("m")).select("vec_id", "m.*")


@query(f"WITH {CEN}, m AS (SELECT vec_id, n AS model, s - d AS s, theme = own_label AS correct FROM best, (VALUES ('a', 0.0::DOUBLE), ('b', 0.05::DOUBLE), ('c', 0.1::DOUBLE)) v(n, d)), k AS (SELECT vec_id FROM m GROUP BY vec_id HAVING min(s) >= 0.5) SELECT model, count(*) AS n, round(avg(CAST(correct AS INTEGER)), 6) AS accuracy FROM m WHERE vec_id IN (SELECT vec_id FROM k) GROUP BY model")
def common_core(t):
    out = E.common_core(_three_models(t), "vec_id", "model", "s", "correct", 0.5)
    return out.select("model", "n", r6("accuracy").alias("accuracy"))


@query(f"WITH {CEN}, g AS (SELECT (300 + 5 * b) / 1000.0::DOUBLE AS threshold, 300 + 5 * b AS th FROM range(0, 139) t(b)), a AS (SELECT threshold, count(*) AS kept, avg(CAST(theme = own_label AS INTEGER)) AS accuracy FROM g JOIN best ON floor((s * 1000 - 300) / 5 + 1e-9) * 5 + 300 >= th GROUP BY threshold) SELECT min(threshold) AS threshold FROM a WHERE kept >= 50 AND accuracy >= 0.9")
def target_threshold(t):
    scored = assigned(t).withColumn("correct", F.col("assigned_theme") == F.col("label"))
    return E.threshold_for(M.calibration(scored, own="similarity"), 0.9)


_VALID = """
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE label <> -1),
pos AS (SELECT label, i, avg(v[i]) AS m, count(*) AS n FROM e, range(1, 65) t(i) GROUP BY label, i),
c AS (SELECT label, list(m ORDER BY i) AS c, max(n) AS n FROM pos GROUP BY label),
w AS (SELECT e.label, avg(list_distance(e.v, c.c)) AS spread, sum(list_distance(e.v, c.c) ** 2) AS within FROM e JOIN c USING (label) GROUP BY e.label),
r AS (SELECT a.label, max((x.spread + y.spread) / list_distance(a.c, b.c)) AS r FROM c a JOIN c b ON a.label <> b.label JOIN w x ON x.label = a.label JOIN w y ON y.label = b.label GROUP BY a.label),
mean AS (SELECT list(m ORDER BY i) AS m FROM (SELECT i, avg(v[i]) AS m FROM e, range(1, 65) t(i) GROUP BY i)),
k AS (SELECT count(*) AS k, sum(c.n) AS n, sum(c.n * list_distance(c.c, mean.m) ** 2) AS between_ FROM c, mean),
s AS (SELECT e.vec_id, max(1 - list_cosine_similarity(e.v, c.c)) FILTER (WHERE c.label = e.label) AS a, min(1 - list_cosine_similarity(e.v, c.c)) FILTER (WHERE c.label <> e.label) AS b FROM e, c GROUP BY e.vec_id)
SELECT (SELECT round(avg(r), 6) FROM r) AS davies_bouldin, (SELECT round(between_ / (k - 1) / ((SELECT sum(within) FROM w) / (n - k)), 6) FROM k) AS calinski_harabasz, (SELECT round(avg((b - a) / greatest(a, b)), 6) FROM s) AS silhouette
"""


@query(_VALID)
def cluster_validity(t):
    out = E.validity(t.embeddings)
    return out.select(*(r6(c).alias(c) for c in out.columns))


_PAIRWISE = """
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE label <> -1),
p AS (SELECT a.vec_id, a.label, b.label AS other, avg(1 - list_cosine_similarity(a.v, b.v)) AS d FROM e a JOIN e b ON a.vec_id <> b.vec_id GROUP BY ALL),
s AS (SELECT vec_id, label, max(d) FILTER (WHERE label = other) AS a, min(d) FILTER (WHERE label <> other) AS b FROM p GROUP BY ALL)
SELECT label, count(*) AS n, round(avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM s GROUP BY label
"""


@query(_PAIRWISE)
def silhouette(t):
    out = E.silhouettes(t.embeddings, "vec_id")
    return out.groupBy("label").agg(F.count("*").alias("n"), r6(F.avg("silhouette")).alias("silhouette"))


@query("WITH r AS (SELECT l_linestatus AS run, l_linenumber AS seed, l_returnflag AS class, avg(CAST(l_discount > 0.04 AS INTEGER)) AS r FROM lineitem GROUP BY ALL), f AS (SELECT class, avg(r) AS r FROM r WHERE run = 'F' GROUP BY class), o AS (SELECT class, avg(r) AS r FROM r WHERE run = 'O' GROUP BY class) SELECT coalesce(f.class, o.class) AS class, round(f.r, 6) AS recall_F, round(o.r, 6) AS recall_O, round(o.r - f.r, 6) AS delta FROM f FULL JOIN o ON f.class = o.class")
def recall_delta(t):
    rows = t.lineitem.withColumn("hit", F.col("l_discount") > 0.04)
    out = E.recall_delta(rows, "l_linestatus", "F", "O", "l_linenumber", "l_returnflag", "hit")
    return out.select("class", *(r6(c).alias(c) for c in out.columns[1:]))


@query("WITH r AS (SELECT user_id % 4 * 90 AS truth, event_id % 4 * 90 AS guess, value FROM events) SELECT truth AS angle, count(*) AS n, round(avg(CAST(truth = guess AS INTEGER)), 6) AS accuracy, round(avg(value) FILTER (WHERE truth = guess), 6) AS sure_right, round(avg(value) FILTER (WHERE truth <> guess), 6) AS sure_wrong FROM r GROUP BY ROLLUP (truth)")
def orientation_accuracy(t):
    rows = t.events.select((F.col("user_id") % 4 * 90).alias("truth"), (F.col("event_id") % 4 * 90).alias("guess"), "value")
    out = E.orientation(rows, "truth", "guess", "value")
    return out.select("angle", "n", *(r6(c).alias(c) for c in out.columns[2:]))


@query("WITH p AS (SELECT o_orderpriority AS subset, unnest(['state', 'year']) AS field, unnest([o_orderstatus, CAST(year(o_orderdate) AS VARCHAR)]) AS status FROM orders) SELECT field, subset, status, n, round(n / sum(n) OVER (PARTITION BY field, subset), 6) AS share FROM (SELECT field, subset, status, count(*) AS n FROM p GROUP BY ALL)")
def status_shares(t):
    rows = t.orders.select("o_orderpriority", F.col("o_orderstatus").alias("state"), F.year("o_orderdate").alias("year"))
    return E.status_shares(rows, "o_orderpriority", ["state", "year"]).withColumn("share", r6("share"))


@query("WITH r AS (SELECT event_id, user_id % 4 * 90 AS a, ((event_id % 4 * 90 - 180) % 360 + 360) % 360 AS b, value AS s, event_id % 100 AS z FROM events) SELECT event_id, CASE WHEN a = b THEN a WHEN z > s THEN b ELSE a END AS angle FROM r")
def two_passes(t):
    angle = E.settled(F.col("user_id") % 4 * 90, F.col("event_id") % 4 * 90, F.col("value"), F.col("event_id") % 100, 180)
    return t.events.select("event_id", angle.alias("angle"))


@query(f"WITH {CEN} SELECT vec_id, CASE WHEN s >= 0.8 THEN 'yes' WHEN s >= 0.8::DOUBLE - 0.12::DOUBLE THEN 'maybe' ELSE 'no' END AS band FROM best")
def banded_match(t):
    return assigned(t).select("vec_id", E.banded(F.col("similarity"), 0.8).alias("band"))


@query("""SELECT vec_id, CASE WHEN label <> -1 THEN label ELSE (SELECT max(label) FROM embeddings) + row_number() OVER (PARTITION BY label ORDER BY vec_id) END AS "group" FROM embeddings""")
def own_groups(t):
    return E.own_groups(t.embeddings.select("vec_id", "label"), "vec_id", "label").select("vec_id", "group")


@query("WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings) SELECT a.vec_id, round(list_cosine_similarity(a.e, b.e), 6) AS identity FROM v a JOIN v b ON b.vec_id = a.vec_id + 1")
def identity_pairs(t):
    a = t.embeddings.select("vec_id", F.col("embedding").alias("a"))
    b = t.embeddings.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("b"))
    return a.join(b, "vec_id").select("vec_id", r6(V.cosine(F.col("a"), F.col("b"))).alias("identity"))
