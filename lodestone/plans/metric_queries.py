"""Evaluation over `embeddings`, `labels`, `documents` and `benchmark`."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import metrics as M
from ..operators import text_pairs as P
from ..operators import themes as TH
from .catalog import query
from .theme_queries import CEN, assigned, r6

_LOO = """
unit AS (SELECT vec_id, label, list_transform(CAST(embedding AS DOUBLE[]), lambda x: x / sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])))) AS u FROM embeddings),
pos AS (SELECT label, i, sum(u[i]) AS m, count(*) AS n FROM unit, range(1, 65) t(i) GROUP BY label, i),
tot AS (SELECT label, list(m ORDER BY i) AS c, max(n) AS n FROM pos GROUP BY label),
own AS (SELECT vec_id, unit.label, list_cosine_similarity(u, list_transform(range(1, 65), lambda i: c[i] - u[i])) AS own FROM unit JOIN tot USING (label) WHERE n > 1),
oth AS (SELECT vec_id, max(list_cosine_similarity(u, c)) AS best_other FROM unit JOIN tot ON unit.label <> tot.label GROUP BY vec_id),
loo AS (SELECT vec_id, label, own, best_other, own > best_other AS correct FROM own JOIN oth USING (vec_id))
"""


@query(f"WITH {_LOO} SELECT vec_id, label, round(own, 6) AS own, round(best_other, 6) AS best_other, correct FROM loo")
def loo_centroid(t):
    return M.leave_one_out(t.embeddings, "vec_id").drop("in_top_3").withColumns({"own": r6("own"), "best_other": r6("best_other")})


_THIRD = "thr AS (SELECT vec_id, list(list_cosine_similarity(u, c) ORDER BY list_cosine_similarity(u, c) DESC)[3] AS third FROM unit JOIN tot ON unit.label <> tot.label GROUP BY vec_id)"


@query(f"WITH {_LOO}, {_THIRD} SELECT label, count(*) AS n, round(avg(CAST(correct AS INTEGER)), 6) AS top_1, round(avg(CAST(coalesce(own > third, true) AS INTEGER)), 6) AS top_3 FROM loo LEFT JOIN thr USING (vec_id) GROUP BY label")
def loo_top_3(t):
    out = M.leave_one_out(t.embeddings, "vec_id")
    share = lambda c: r6(F.avg(F.col(c).cast("int")))
    return out.groupBy("label").agg(F.count("*").alias("n"), share("correct").alias("top_1"), share("in_top_3").alias("top_3"))


_SINGLES = _LOO.replace("FROM embeddings)", "FROM (SELECT vec_id, embedding, CASE WHEN vec_id % 53 = 7 THEN 1000 + vec_id ELSE label END AS label FROM embeddings))").replace(
    "list_cosine_similarity(u, list_transform(range(1, 65), lambda i: c[i] - u[i])) AS own FROM unit JOIN tot USING (label) WHERE n > 1",
    "CASE WHEN n > 1 THEN list_cosine_similarity(u, list_transform(range(1, 65), lambda i: c[i] - u[i])) ELSE 0 END AS own FROM unit JOIN tot USING (label)",
)


@query(f"WITH {_SINGLES} SELECT vec_id, label, round(own, 6) AS own, round(best_other, 6) AS best_other, correct FROM loo")
def loo_with_singles(t):
    label = F.when(F.col("vec_id") % 53 == 7, F.col("vec_id") + 1000).otherwise(F.col("label")).cast("int")
    out = M.leave_one_out(t.embeddings.withColumn("label", label), "vec_id", singles=True)
    return out.drop("in_top_3").withColumns({"label": F.col("label").cast("long"), "own": r6("own"), "best_other": r6("best_other")})


@query(f"WITH {_LOO} SELECT count(*) AS n, round(avg(CAST(correct AS INTEGER)), 6) AS top_1, round(avg(own), 6) AS mean_own, round(avg(own - best_other), 6) AS mean_margin FROM loo")
def loo_summary(t):
    out = M.leave_one_out(t.embeddings, "vec_id")
    return out.agg(
        F.count("*").alias("n"), r6(F.avg(F.col("correct").cast("int"))).alias("top_1"), r6(F.avg("own")).alias("mean_own"),
        r6(F.avg(F.col("own") - F.col("best_other"))).alias("mean_margin"),
    )


@query(f"WITH {_LOO}, g AS (SELECT (300 + 5 * i) / 1000 AS threshold FROM range(0, 139) t(i)), c AS (SELECT threshold, count(*) FILTER (WHERE own >= threshold - 1e-12) AS kept, count(*) FILTER (WHERE own >= threshold - 1e-12 AND correct) AS good, count(*) AS n FROM loo, g GROUP BY threshold) SELECT threshold, kept, round(1 - kept / n, 6) AS unknown_share, round(good / kept, 6) AS accuracy FROM c WHERE kept >= 50")
def calibration_curve(t):
    out = M.calibration(M.leave_one_out(t.embeddings, "vec_id"))
    return out.withColumns({"unknown_share": r6("unknown_share"), "accuracy": r6("accuracy")})


@query("""
WITH p AS (SELECT a.vec_id AS q, a.label AS l, b.label AS m, row_number() OVER (PARTITION BY a.vec_id ORDER BY list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) DESC, b.vec_id) AS r FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id)
SELECT l AS label, count(DISTINCT q) AS n, round(avg(CAST(l = m AS INTEGER)), 6) AS purity FROM p WHERE r <= 10 GROUP BY l""")
def knn_purity(t):
    near = M.nearest_neighbours(t.embeddings, "vec_id")
    hit = (F.col("label") == F.col("query_label")).cast("int")
    return near.withColumn("hit", hit).groupBy(F.col("query_label").alias("label")).agg((F.count("*") / 10).cast("long").alias("n"), r6(F.avg("hit")).alias("purity"))


@query(f"WITH {CEN}, t AS (SELECT own_label AS a, theme AS b, CAST(count(*) AS DOUBLE) AS n FROM best GROUP BY ALL), s AS (SELECT sum(n) AS t, sum(n*(n-1)/2) AS p, sum(n*ln(n)) AS x FROM t), l AS (SELECT sum(n*(n-1)/2) AS p, sum(n*ln(n)) AS x FROM (SELECT sum(n) AS n FROM t GROUP BY a)), r AS (SELECT sum(n*(n-1)/2) AS p, sum(n*ln(n)) AS x FROM (SELECT sum(n) AS n FROM t GROUP BY b)) SELECT round((s.p - l.p*r.p/(t*(t-1)/2)) / ((l.p+r.p)/2 - l.p*r.p/(t*(t-1)/2)), 6) AS ari, round(((s.x-l.x-r.x)/t + ln(t)) / ((ln(t)-l.x/t + ln(t)-r.x/t)/2), 6) AS nmi FROM s, l, r")
def ari_nmi(t):
    out = M.agreement(assigned(t), "label", "assigned_theme")
    return out.select(r6("ari").alias("ari"), r6("nmi").alias("nmi"))


@query(f"WITH {CEN} SELECT own_label AS from_theme, theme AS to_theme, count(*) AS n FROM best WHERE own_label <> theme GROUP BY ALL ORDER BY n DESC, from_theme, to_theme LIMIT 15")
def transition_matrix(t):
    moved = M.contingency(assigned(t), "label", "assigned_theme").filter("a <> b")
    return moved.select(F.col("a").alias("from_theme"), F.col("b").alias("to_theme"), F.col("n").cast("long").alias("n")).orderBy(F.desc("n"), "from_theme", "to_theme").limit(15)


@query(f"WITH {CEN} SELECT count(*) AS n, round(avg(CAST(s >= 0.5 AS INTEGER)), 6) AS coverage, round(avg(CAST(own_label <> theme AS INTEGER)), 6) AS disagreement, round(avg(CAST(own_label <> theme AS INTEGER)) FILTER (WHERE s >= 0.5), 6) AS moved FROM best")
def moved_fraction(t):
    off, kept = (F.col("label") != F.col("assigned_theme")).cast("int"), F.col("similarity") >= 0.5
    return assigned(t).agg(
        F.count("*").alias("n"), r6(F.avg(kept.cast("int"))).alias("coverage"), r6(F.avg(off)).alias("disagreement"), r6(F.avg(F.when(kept, off))).alias("moved")
    )


@query(f"WITH {CEN} SELECT label, count(*) AS n, round(avg(s), 6) AS mean, round(quantile_cont(s, 0.5), 6) AS median, round(min(s), 6) AS least FROM sims WHERE label = own_label GROUP BY label")
def intra_cluster(t):
    out = M.within_clusters(t.embeddings, TH.centroids(t.embeddings))
    return out.withColumns({c: r6(c) for c in ("mean", "median", "least")})


_GUESS = r"""
p AS (SELECT l.doc_id, l.quality AS truth, CASE WHEN d.n_chars > 20000 THEN NULL WHEN d.n_chars >= 100 THEN 1 ELSE 0 END AS guess FROM labels l JOIN documents d USING (doc_id))
"""


def guesses(t):
    docs = t.documents.select("doc_id", "n_chars")
    guess = F.when(F.col("n_chars") > 20000, F.lit(None)).when(F.col("n_chars") >= 100, 1).otherwise(0)
    return t.labels.join(docs, "doc_id").select("doc_id", F.col("quality").alias("truth"), guess.alias("guess"))


@query(f"""WITH {_GUESS}, c AS (SELECT k AS class, count(*) FILTER (WHERE truth = k) AS n, count(*) FILTER (WHERE truth = k AND guess = k) AS tp, count(*) FILTER (WHERE guess = k AND truth <> k) AS fp FROM p, (VALUES (0), (1)) v(k) GROUP BY k),
m AS (SELECT class, n, tp, fp, n - tp AS fn, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS precision, CASE WHEN n > 0 THEN tp / n ELSE 0 END AS recall FROM c WHERE n + fp > 0)
SELECT class, n, tp, fp, fn, round(precision, 6) AS precision, round(recall, 6) AS recall, round(CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END, 6) AS f1 FROM m""")
def classifier_metrics(t):
    return M.classifier(guesses(t), "truth", "guess").withColumns({c: r6(c) for c in ("precision", "recall", "f1")})


@query(f"WITH {_GUESS} SELECT truth AS true_class, guess AS predicted_class, count(*) AS n FROM p WHERE truth IS DISTINCT FROM guess GROUP BY ALL ORDER BY n DESC, true_class, predicted_class LIMIT 12")
def confusions(t):
    return M.confusions(guesses(t), "truth", "guess")


@query("""
WITH n AS (SELECT lang AS g, source AS k, count(*) AS n FROM documents GROUP BY ALL), s AS (SELECT g, k, n / sum(n) OVER (PARTITION BY g) AS p FROM n),
g AS (SELECT DISTINCT g FROM s), k AS (SELECT DISTINCT k FROM s), f AS (SELECT g.g, k.k, coalesce(p, 0) AS p FROM g CROSS JOIN k LEFT JOIN s USING (g, k)),
x AS (SELECT a.g AS a, b.g AS b, a.p, b.p AS q, (a.p + b.p) / 2 AS m FROM f a JOIN f b ON a.k = b.k AND a.g < b.g)
SELECT a, b, round(sum(CASE WHEN p > 0 THEN p * ln(p / m) ELSE 0 END + CASE WHEN q > 0 THEN q * ln(q / m) ELSE 0 END) / 2, 6) AS js, round(sum(p * q) / (sqrt(sum(p * p)) * sqrt(sum(q * q))), 6) AS cosine FROM x GROUP BY a, b""")
def js_divergence(t):
    return M.divergence(M.shares(t.documents, "lang", "source")).withColumns({"js": r6("js"), "cosine": r6("cosine")})


@query("WITH r AS (SELECT event_type, user_id, avg(value) AS v FROM events GROUP BY ALL) SELECT event_type, round(avg(v), 6) AS mean, round(min(v), 6) AS least, round(max(v), 6) AS most, round(stddev_pop(v), 6) AS deviation FROM r GROUP BY event_type")
def seed_aggregate(t):
    per_run = t.events.groupBy("event_type", "user_id").agg(F.avg("value").alias("v"))
    return M.over_seeds(per_run, "event_type", "v").withColumns({c: r6(c) for c in ("mean", "least", "most", "deviation")})


@query("SELECT o_orderkey, CASE WHEN a = b OR a = c THEN a WHEN b = c THEN b ELSE a END AS vote FROM (SELECT o_orderkey, o_orderkey % 3 AS a, o_custkey % 3 AS b, CAST(day(o_orderdate) AS BIGINT) % 3 AS c FROM orders)")
def majority_vote(t):
    votes = [F.col("o_orderkey") % 3, F.col("o_custkey") % 3, F.day("o_orderdate").cast("long") % 3]
    return t.orders.select("o_orderkey", M.first_majority(votes).alias("vote"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = l_linestatus OR l_discount >= l_tax THEN l_returnflag ELSE l_linestatus END AS label, round(CASE WHEN l_returnflag = l_linestatus THEN (l_discount + l_tax) / 2 ELSE greatest(l_discount, l_tax) END, 6) AS confidence FROM lineitem")
def ensemble_vote(t):
    v = M.vote_of_two(F.col("l_returnflag"), F.col("l_discount"), F.col("l_linestatus"), F.col("l_tax"))
    return t.lineitem.select("l_orderkey", "l_linenumber", v["label"].alias("label"), r6(v["confidence"]).alias("confidence"))


_PAIR = r"""
n AS (SELECT item_id, trim(regexp_replace(regexp_replace(lower(text), '[|#]+|[-=_*]{3,}|<[^>]+>', ' ', 'g'), '[\s\x0b\x85\p{Z}]+', ' ', 'g')) AS a FROM benchmark),
n2 AS (SELECT item_id, a, trim(regexp_replace(replace(replace(a, 'th', 'd'), ' in ', ' '), '[\s]+', ' ', 'g')) AS b FROM n)
"""


def readings(t):
    """Benchmark texts and a misreading of each."""
    truth = T.recognised(F.col("text"))
    return t.benchmark.select("item_id", F.col("text").alias("truth"), F.replace(F.replace(truth, F.lit("th"), F.lit("d")), F.lit(" in "), F.lit(" ")).alias("found"))


@query(f"WITH {_PAIR} SELECT item_id, round(levenshtein(a, b) / length(a), 6) AS cer, round(length(b) / length(a), 6) AS coverage FROM n2")
def cer(t):
    a, b = F.col("truth"), F.col("found")
    return readings(t).select("item_id", r6(P.char_error_rate(a, b)).alias("cer"), r6(P.length_coverage(a, b)).alias("coverage"))


@query()
def wer(t):
    return readings(t).select("item_id", r6(P.word_error_rate(F.col("truth"), F.col("found"))).alias("wer"))


_BAG = """
x AS (SELECT item_id, unnest({a}) AS w, 1 AS s FROM n2 UNION ALL SELECT item_id, unnest({b}), 0 FROM n2),
c AS (SELECT item_id, w, sum(s) AS a, sum(1 - s) AS b FROM x GROUP BY ALL),
o AS (SELECT item_id, sum(a) AS na, sum(b) AS nb, sum(least(a, b)) AS common, sum(greatest(a - b, 0)) AS missed, sum(greatest(b - a, 0)) AS invented FROM c GROUP BY item_id)
"""


@query(f"WITH {_PAIR}, {_BAG.format(a='string_split(a, chr(32))', b='string_split(b, chr(32))')} SELECT item_id, CAST(missed AS BIGINT) AS missed, CAST(invented AS BIGINT) AS invented, round(2 * common / (na + nb), 6) AS f1 FROM o")
def bow_f1(t):
    overlap = P.bag_overlap(readings(t), "item_id", T.recognised_words(F.col("truth")), T.recognised_words(F.col("found")))
    return P.bag_f1(overlap).select("item_id", "missed", "invented", r6("f1").alias("f1"))


@query(f"WITH {_PAIR}, {_BAG.format(a='list_transform(range(1, length(a) - 1), lambda i: substr(a, i, 3))', b='list_transform(range(1, length(b) - 1), lambda i: substr(b, i, 3))')} SELECT item_id, round(common / sqrt(na * nb), 6) AS similarity FROM o")
def char_ngram_overlap(t):
    overlap = P.bag_overlap(readings(t), "item_id", P.ngram_counts(F.col("truth"), 3), P.ngram_counts(F.col("found"), 3))
    return P.gram_similarity(overlap).select("item_id", r6("similarity").alias("similarity"))


@query("SELECT count(l_orderkey) AS pairs, count(*) FILTER (WHERE l_discount - l_tax > 0.01) AS wins, count(*) FILTER (WHERE abs(l_discount - l_tax) <= 0.01) AS ties, count(*) FILTER (WHERE l_discount - l_tax < -0.01) AS losses, count(*) FILTER (WHERE l_discount >= 0.95) AS at_95, count(*) FILTER (WHERE l_discount >= 0.8) AS at_80, count(*) FILTER (WHERE l_discount >= 0.5) AS at_50, round(avg(l_discount - l_tax), 6) AS mean_gap FROM lineitem")
def paired_analysis(t):
    return P.paired(t.lineitem, "l_orderkey", "l_discount", "l_tax").withColumn("mean_gap", r6("mean_gap"))


@query("WITH c AS (SELECT quality, count(*) AS n FROM labels GROUP BY quality) SELECT round(max(n) / min(n), 6) AS ratio, max(n) / min(n) > 3 AS unbalanced FROM c")
def class_balance(t):
    n = t.labels.groupBy("quality").count()
    ratio = F.max("count") / F.min("count")
    return n.agg(r6(ratio).alias("ratio"), (ratio > 3).alias("unbalanced"))
