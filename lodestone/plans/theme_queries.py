"""Themes over `embeddings`: centroids, assignment, override, drift, members, merging, registry, terms."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import vectors as V
from ..operators import density, linkage
from ..operators import themes as TH
from .catalog import query

#: Centroids, all similarities and the best one, for the SQL twins.
CEN = """
pos AS (SELECT label, i, avg(CAST(embedding[i] AS DOUBLE)) AS m, count(*) AS n FROM embeddings, range(1, 65) t(i) WHERE label <> -1 GROUP BY label, i),
cen AS (SELECT label, list(m ORDER BY i) AS c, max(n) AS n FROM pos GROUP BY label),
sims AS (SELECT e.vec_id, e.label AS own_label, cen.label, list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), cen.c) AS s FROM embeddings e, cen),
best AS (SELECT vec_id, own_label, arg_max(label, s) AS theme, max(s) AS s, list(s ORDER BY s DESC)[2] AS s2 FROM sims GROUP BY vec_id, own_label)
"""


def assigned(t):
    return TH.assign(t.embeddings, TH.centroids(t.embeddings))


def r6(c):
    return F.round(c, 6)


@query(f"WITH {CEN} SELECT vec_id, theme AS assigned_theme, round(s, 6) AS similarity, s < 0.8 AS is_unknown FROM best")
def assign_nearest_centroid(t):
    return assigned(t).select("vec_id", "assigned_theme", r6("similarity").alias("similarity"), "is_unknown")


@query("SELECT label, round(list_sum(list_transform(list(m ORDER BY i), lambda x: x * x)), 6) AS square, CAST(max(n) AS BIGINT) AS n FROM (SELECT label, i, avg(CAST(embedding[i] AS DOUBLE)) AS m, count(*) AS n FROM embeddings, range(1, 65) t(i) WHERE label <> -1 GROUP BY label, i) GROUP BY label")
def theme_centroids(t):
    c = TH.centroids(t.embeddings)
    return c.select("label", r6(V.dot(F.col("centroid"), F.col("centroid"))).alias("square"), "n")


@query(f"WITH {CEN} SELECT theme AS assigned_theme, count(*) AS n, round(avg(s), 6) AS avg_similarity, count(*) FILTER (WHERE s < 0.8) AS n_unknown FROM best GROUP BY theme")
def theme_coverage(t):
    return TH.coverage(assigned(t)).withColumn("avg_similarity", r6("avg_similarity"))


@query(f"WITH {CEN} SELECT vec_id, round(s, 6) AS similarity, round(s2, 6) AS second_similarity, round(s - s2, 6) AS margin FROM best")
def assign_margin(t):
    a = assigned(t)
    return a.select("vec_id", r6("similarity").alias("similarity"), r6("second_similarity").alias("second_similarity"), r6(F.col("similarity") - F.col("second_similarity")).alias("margin"))


@query(f"WITH {CEN}, marked AS (SELECT doc_id FROM labels WHERE toxic = 1) SELECT vec_id, CASE WHEN vec_id IN (SELECT doc_id FROM marked) THEN 90 ELSE theme END AS assigned_theme, round(s, 6) AS similarity, s < 0.8 AND vec_id NOT IN (SELECT doc_id FROM marked) AS is_unknown FROM best")
def marked_override(t):
    marked = t.labels.filter("toxic = 1").select(F.col("doc_id").alias("vec_id"))
    out = TH.override(assigned(t), marked, "vec_id")
    return out.select("vec_id", "assigned_theme", r6("similarity").alias("similarity"), "is_unknown")


@query(f"WITH {CEN} SELECT vec_id, theme AS assigned_theme, round(s, 6) AS similarity FROM best WHERE s < 0.8")
def drift_buffer(t):
    return assigned(t).filter("is_unknown").select("vec_id", "assigned_theme", r6("similarity").alias("similarity"))


@query(f"WITH {CEN}, rest AS (SELECT vec_id FROM best WHERE s < 0.8), again AS (SELECT * FROM best JOIN rest USING (vec_id)) SELECT vec_id, theme AS assigned_theme, round(s, 6) AS similarity FROM again WHERE s >= 0.4")
def drift_assign(t):
    out = TH.drifted(assigned(t), TH.centroids(t.embeddings), threshold=0.4)
    return out.select("vec_id", "assigned_theme", r6("similarity").alias("similarity"))


@query(f"WITH {CEN}, marked AS (SELECT doc_id FROM labels WHERE toxic = 1) SELECT vec_id, CASE WHEN vec_id IN (SELECT doc_id FROM marked) THEN 'marked' WHEN s < 0.8 THEN 'noise' ELSE 'T' || theme END AS resolved FROM best")
def resolved_label(t):
    marked = t.labels.filter("toxic = 1").select(F.col("doc_id").alias("vec_id"), F.lit(True).alias("m"))
    a = assigned(t).join(marked, "vec_id", "left")
    none = F.lit(None).cast("int")
    return a.select("vec_id", TH.resolved(F.coalesce("m", F.lit(False)), none, F.col("is_unknown"), F.col("assigned_theme")).alias("resolved"))


@query(f"WITH {CEN}, r AS (SELECT label, vec_id, s, row_number() OVER (PARTITION BY label ORDER BY s DESC, vec_id) AS rank FROM sims WHERE label = own_label) SELECT label, vec_id, round(s, 6) AS similarity, rank FROM r WHERE rank <= 5")
def cluster_top_members(t):
    return TH.top_members(t.embeddings, TH.centroids(t.embeddings), "vec_id").withColumn("similarity", r6("similarity"))


@query("WITH u AS (SELECT vec_id, embedding[1:16] AS e FROM embeddings) SELECT vec_id, round(list_cosine_similarity(CAST(e AS DOUBLE[]), list_transform(range(1, 17), lambda i: CASE WHEN i = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)), 6) AS first_share FROM u")
def truncated_vectors(t):
    return t.embeddings.select("vec_id", r6(F.get(V.truncated(F.col("embedding"), 16), 0)).alias("first_share"))


@query("WITH p AS (SELECT a.vec_id, [CAST(x AS DOUBLE) FOR x IN a.embedding] AS t, [CAST(x AS DOUBLE) FOR x IN b.embedding] AS i FROM embeddings a LEFT JOIN (SELECT * FROM embeddings WHERE label < 5) b ON a.vec_id = b.vec_id + 1) SELECT vec_id, round(CASE WHEN i IS NULL THEN t[1] ELSE (t[1] + i[1]) / 2 END, 6) AS first FROM p")
def combined_vectors(t):
    e = t.embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("text"), "label")
    images = e.filter("label < 5").select((F.col("vec_id") + 1).alias("vec_id"), F.col("text").alias("image"))
    both = e.join(images, "vec_id", "left")
    return both.select("vec_id", r6(F.get(V.combined(F.col("text"), F.col("image")), 0)).alias("first"))


@query()
def merge_centroids(t):
    themes = TH.centroids(t.embeddings)
    mapping = TH.merge_themes(themes, 0.6)
    return TH.relabelled(themes.select("label", "n").withColumn("old_label", F.col("label")), mapping)


@query()
def greedy_topic_merge(t):
    themes = TH.centroids(t.embeddings)
    return TH.relabelled(themes.select("label", "n").withColumn("old_label", F.col("label")), TH.greedy_topics(themes, 0.5))


@query()
def registry_extend(t):
    themes = TH.centroids(t.embeddings)
    old, new = themes.filter("label < 5"), themes.filter("label >= 5")
    return TH.relabelled(new.select("label", "n").withColumn("old_label", F.col("label")), TH.extend_registry(old, new))


@query()
def second_level_themes(t):
    return TH.second_level(t.embeddings).groupBy("label", "sub_label").agg(F.count("*").alias("n"))


#: Share of the rows that a density cluster has at least.
LEAST_SHARE = 0.01


@query()
def density_clusters(t):
    least = max(2, int(LEAST_SHARE * t.embeddings.count()))
    return density.clusters(t.embeddings, "vec_id", least)


@query()
def density_clusters_with_epsilon(t):
    # Clusters that part at a cosine of 0.8 or more stay together; core distances by five neighbours.
    least = max(2, int(LEAST_SHARE * t.embeddings.count()))
    return density.clusters(t.embeddings, "vec_id", least, neighbours=5, epsilon=(2 * (1 - 0.8)) ** 0.5)


@query()
def average_link_clusters(t):
    return linkage.clusters(t.embeddings, "vec_id", 0.5)


@query(r"""
WITH w AS (SELECT source AS g, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}_][\p{L}\p{N}_]+') AS w FROM documents),
terms AS (SELECT g, unnest(w) AS term FROM w UNION ALL SELECT g, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM w WHERE len(w) > 1),
tf AS (SELECT g, term, count(*) AS tf FROM terms GROUP BY ALL),
m AS (SELECT avg(n) AS n FROM (SELECT sum(tf) AS n FROM tf GROUP BY g)),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
s AS (SELECT g, term, tf, tf * ln(1 + m.n / df) AS score FROM tf JOIN df USING (term), m),
r AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY round(score, 9) DESC, term) AS rank FROM s WHERE score > 0)
SELECT g AS "group", term, tf, round(score, 4) AS score, rank FROM r WHERE rank <= 10""")
def ctfidf_top_terms(t):
    return TH.class_terms(t.documents, "source").withColumn("score", F.round("score", 4))


@query(r"SELECT doc_id, CAST(len(regexp_extract_all(lower(coalesce(text, '')), '[\p{L}_][\p{L}\p{N}_]+')) AS INTEGER) AS n FROM documents")
def term_counts(t):
    return t.documents.select("doc_id", F.size(T.term_words(F.col("text"))).alias("n"))
