"""Agreement of partitions over seeds, joint statuses, accuracy by size of group, sizes after cleaning, categories of files."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import files
from ..operators import agreement, gates
from .catalog import query
from .theme_queries import r6

_CATEGORIES = {"page": (".html", ".htm"), "site": (".com", ".org", ".net"), "old": (".htm",)}


@query("""
WITH r AS (SELECT s AS seed, label AS a, (v[s] > 0)::INT + 2 * (v[s + 1] > 0)::INT + 4 * (v[s + 2] > 0)::INT AS b FROM (SELECT label, embedding AS v FROM embeddings), range(1, 6) t(s)),
t AS (SELECT seed, a, b, count(*)::DOUBLE AS n FROM r WHERE a IS NOT NULL AND b IS NOT NULL GROUP BY ALL),
s AS (SELECT seed, sum(n) AS t, sum(n * (n - 1) / 2) AS p, sum(n * ln(n)) AS x FROM t GROUP BY seed),
l AS (SELECT seed, sum(n * (n - 1) / 2) AS p, sum(n * ln(n)) AS x FROM (SELECT seed, sum(n) AS n FROM t GROUP BY seed, a) GROUP BY seed),
q AS (SELECT seed, sum(n * (n - 1) / 2) AS p, sum(n * ln(n)) AS x FROM (SELECT seed, sum(n) AS n FROM t GROUP BY seed, b) GROUP BY seed),
m AS (SELECT (s.p - l.p * q.p / (t * (t - 1) / 2)) / ((l.p + q.p) / 2 - l.p * q.p / (t * (t - 1) / 2)) AS ari, 2 * ((s.x - l.x - q.x) / t + ln(t)) / (2 * ln(t) - (l.x + q.x) / t) AS nmi
 FROM s JOIN l USING (seed) JOIN q USING (seed))
SELECT round(avg(ari), 6) AS ari_mean, round(stddev_pop(ari), 6) AS ari_std, round(min(ari), 6) AS ari_min, round(max(ari), 6) AS ari_max, round(max(ari) - min(ari), 6) AS ari_spread,
 round(avg(nmi), 6) AS nmi_mean, round(stddev_pop(nmi), 6) AS nmi_std, round(min(nmi), 6) AS nmi_min, round(max(nmi), 6) AS nmi_max, round(max(nmi) - min(nmi), 6) AS nmi_spread FROM m""")
def seed_agreement(t):
    """Labels against five partitions of the vectors, each by the signs of three entries that its seed names."""
    rows = t.embeddings.select("label", "embedding", F.explode(F.sequence(F.lit(1), F.lit(5))).alias("seed"))
    sign = lambda i: (F.get("embedding", F.col("seed") - 1 + i) > 0).cast("int")
    by_seed = agreement.agreement_by_run(rows.withColumn("part", sign(0) + 2 * sign(1) + 4 * sign(2)), "seed", "label", "part")
    out = agreement.spread(by_seed, "ari", "nmi")
    return out.select(*(r6(c).alias(c) for c in out.columns))


_STATUS = "CASE WHEN {0} IS NULL AND {1} IS NULL THEN 'both_missing' WHEN {0} IS NULL THEN 'left_missing' WHEN {1} IS NULL THEN 'right_missing' WHEN {0} = {1} THEN 'match' ELSE 'mismatch' END"
_PAIRED = ", ".join(f"{_STATUS.format(f'a.{c}', f'b.{c}')} AS {c}_status" for c in ("l_returnflag", "l_linestatus", "l_tax"))


@query(f"""
WITH o AS (SELECT * FROM lineitem WHERE l_linenumber = 1), w AS (SELECT * FROM lineitem WHERE l_linenumber = 2),
j AS (SELECT a.l_quantity, {_PAIRED} FROM o a LEFT JOIN w b USING (l_orderkey)),
x AS (SELECT 'all' AS subset, * FROM j UNION ALL SELECT 'large', * FROM j WHERE l_quantity > 25 UNION ALL SELECT 'small', * FROM j WHERE l_quantity <= 25),
f AS (SELECT subset, l_returnflag_status = 'match' AND l_linestatus_status = 'match' AND l_tax_status = 'match' AS same, 'mismatch' IN (l_returnflag_status, l_linestatus_status, l_tax_status) AS apart FROM x)
SELECT subset, count(*) AS n, count(*) FILTER (WHERE same) AS all_match, round(avg(same::INT), 6) AS all_match_share, count(*) FILTER (WHERE apart) AS any_mismatch, round(avg(apart::INT), 6) AS any_mismatch_share FROM f GROUP BY subset""")
def joint_match(t):
    """The first two lines of each order, field by field."""
    fields = ["l_returnflag", "l_linestatus", "l_tax"]
    side = lambda n, s: t.lineitem.filter(F.col("l_linenumber") == n).select("l_orderkey", *(F.col(c).alias(f"{s}_{c}") for c in fields), F.col("l_quantity").alias(f"{s}_quantity"))
    pairs = side(1, "a").join(side(2, "b"), "l_orderkey", "left")
    status = {f"{c}_status": F.expr(_STATUS.format(f"a_{c}", f"b_{c}")) for c in fields}
    subsets = {"all": F.lit(True), "large": F.col("a_quantity") > 25, "small": F.col("a_quantity") <= 25}
    out = agreement.joint_statuses(pairs.withColumns(status), list(status), subsets)
    return out.withColumns({c: r6(c) for c in ("all_match_share", "any_mismatch_share")})


@query("""
WITH d AS (SELECT md5(text) AS g, lang AS truth, CASE WHEN contains(text, ' the ') THEN 'en' WHEN contains(text, ' der ') THEN 'de' WHEN contains(text, ' les ') THEN 'fr' WHEN contains(text, ' el ') THEN 'es' END AS guess FROM documents),
n AS (SELECT *, CASE WHEN g IS NULL OR count(*) OVER (PARTITION BY g) = 1 THEN 'single' ELSE 'in_group' END AS part FROM d),
x AS (SELECT part, truth, guess FROM n UNION ALL SELECT 'all', truth, guess FROM n)
SELECT part, count(*) AS n, count(*) FILTER (WHERE guess = truth) AS correct, round(count(*) FILTER (WHERE guess = truth) / count(*), 6) AS accuracy FROM x WHERE truth IS NOT NULL GROUP BY part""")
def accuracy_by_group(t):
    """Languages told by one word each, for texts that stand once and for those that are repeated."""
    has = lambda w: F.contains(F.col("text"), F.lit(f" {w} "))
    guess = F.when(has("the"), "en").when(has("der"), "de").when(has("les"), "fr").when(has("el"), "es")
    return agreement.accuracy_by_group(t.documents, F.md5("text"), F.col("lang"), guess).withColumn("accuracy", r6("accuracy"))


@query("""
WITH d AS (SELECT source, lang, n_chars % 13 AS votes, CASE WHEN contains(text, ' the ') THEN 'en' ELSE 'de' END AS ensemble, CASE WHEN contains(text, ' of ') THEN 'en' END AS judge FROM documents)
SELECT source, count(*) AS size_before, count(*) FILTER (WHERE NOT coalesce(ensemble <> lang AND votes >= 9 AND ensemble IS DISTINCT FROM judge, false)) AS size_after FROM d WHERE source IS NOT NULL GROUP BY source""")
def cleaned_group_sizes(t):
    has = lambda w: F.coalesce(F.contains(F.col("text"), F.lit(f" {w} ")), F.lit(False))
    ensemble, judge = F.when(has("the"), "en").otherwise("de"), F.when(has("of"), "en")
    rows = gates.cleaned_labels(t.documents, F.col("lang"), ensemble, F.col("n_chars") % 13, F.lit(None).cast("string"), judge)
    return agreement.sizes_after(rows, "source")


@query(r"""
WITH p AS (SELECT page_id, lower(regexp_extract(url, '(\.[^./\\]+)$', 1)) AS e FROM pages)
SELECT page_id, CASE WHEN e IN ('.html', '.htm') THEN 'page' WHEN e IN ('.com', '.org', '.net') THEN 'site' ELSE 'other' END AS category FROM p""")
def file_categories(t):
    return t.pages.select("page_id", files.category(F.col("url"), _CATEGORIES, "other").alias("category"))
