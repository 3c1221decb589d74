"""Formal documents, term and identity tests, names that are shown, kinds of files in containers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T, vectors as V
from ..operators import graph, invoices, metrics as M, text_pairs as P
from .catalog import query

PLACES = invoices.Places({str(k): f"Region {k}" for k in range(20)})


def r6(c):
    return F.round(c, 6)


@query("""
WITH l AS (SELECT l_orderkey AS k, 'Part ' || (l_partkey % 3) AS b, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS i FROM lineitem),
m AS (SELECT *, i - row_number() OVER (PARTITION BY k, b ORDER BY i) AS g FROM l WHERE i <= 5),
r AS (SELECT k, b, min(i) AS f, CASE WHEN count(*) > 1 THEN '-' || max(i) ELSE '' END AS t, CASE WHEN count(*) > 1 THEN ' (×' || count(*) || ')' ELSE '' END AS n FROM m GROUP BY k, b, g),
s AS (SELECT k, string_agg('Т' || f || t || ': ' || b || ' [ед:шт]' || n, ' | ' ORDER BY f) AS full_rows, string_agg(b || ' [ед:шт]' || n, ' | ' ORDER BY f) AS subject FROM r GROUP BY k),
c AS (SELECT k, count(*) AS n FROM l GROUP BY k)
SELECT o_orderkey, '№' || o_orderkey || ' от ' || strftime(o_orderdate, '%d.%m.%Y') || ' | Прод: Org ' || c_custkey || ' (ИНН ' || (7700000000 + c_custkey) || ')'
 || CASE WHEN c_nationkey < 20 THEN ' Рег: Region ' || c_nationkey ELSE '' END || ' | ' || full_rows || ' | Опер: Поставка по заказу' AS full_text, subject AS subject_text,
 CAST(c.n AS INT) AS n_rows, CASE WHEN c_nationkey < 20 THEN 'Region ' || c_nationkey ELSE '' END AS seller_region
FROM orders JOIN customer ON o_custkey = c_custkey JOIN s ON s.k = o_orderkey JOIN c ON c.k = o_orderkey""")
def invoice_text(t):
    row = F.concat(F.lit('<СведТов НаимТов="Part '), (F.col("l_partkey") % 3).cast("string"), F.lit('" НаимЕдИзм="шт"/>'))
    lines = t.lineitem.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", row.alias("row")))).alias("lines"))
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    # Few bytes and much work: by its size alone the join would end in one task.
    joined = joined.repartition(int(t.spark.conf.get("spark.sql.shuffle.partitions")), "o_orderkey")
    xml = F.concat(
        F.lit('<?xml version="1.0" encoding="windows-1251"?><Файл><Документ><СвСчФакт НомерДок="'), F.col("o_orderkey").cast("string"),
        F.lit('" ДатаДок="'), F.date_format("o_orderdate", "dd.MM.yyyy"), F.lit('"><СвПрод><ИдСв><СвЮЛУч НаимОрг="Org '), F.col("c_custkey").cast("string"),
        F.lit('" ИННЮЛ="'), (F.lit(7700000000) + F.col("c_custkey")).cast("string"),
        F.lit('"/></ИдСв><Адрес><АдрРФ КодРегион="'), F.col("c_nationkey").cast("string"), F.lit('"/></Адрес></СвПрод></СвСчФакт><ТаблСчФакт>'),
        F.array_join(F.col("lines.row"), ""), F.lit('</ТаблСчФакт><СвПродПер><СвПер СодОпер="Поставка по  заказу"/></СвПродПер></Документ></Файл>'),
    )
    out = invoices.canonical(joined.select("o_orderkey", xml.alias("xml")), PLACES)
    return out.select("o_orderkey", "full_text", "subject_text", "fields.n_rows", "fields.seller_region")


@query("""
WITH p AS (SELECT vec_id, embedding::DOUBLE[] AS t, list_transform(embedding::DOUBLE[], lambda x, i: x + 0.4 * ((i * 7 + vec_id) % 5 - 2)) AS f FROM embeddings),
o AS (SELECT vec_id, f, list_cosine_similarity(t, f) AS own FROM p),
r AS (SELECT o.vec_id, any_value(own) AS own, 1 + count(*) FILTER (WHERE p.vec_id <> o.vec_id AND list_cosine_similarity(p.t, o.f) > own) AS rank FROM o CROSS JOIN p GROUP BY o.vec_id)
SELECT count(*) AS n, round(avg(own), 6) AS cosine_mean, round(median(own), 6) AS cosine_median, round(min(own), 6) AS cosine_min,
 round(avg(CAST(rank <= 1 AS INT)), 6) AS top1, round(avg(CAST(rank <= 5 AS INT)), 6) AS top5 FROM r""")
def identity_retrieval(t):
    moved = F.transform("embedding", lambda x, i: x.cast("double") + 0.4 * (((i + 1) * 7 + F.col("vec_id")) % 5 - 2))
    ranks = M.identity_ranks(t.embeddings.select("vec_id", "embedding", moved.alias("found")), "vec_id", "embedding", "found")
    share = lambda k: r6(F.avg((F.col("rank") <= k).cast("int")))
    return ranks.agg(
        F.count("*").alias("n"), r6(F.avg("own")).alias("cosine_mean"), r6(F.median("own")).alias("cosine_median"), r6(F.min("own")).alias("cosine_min"),
        share(1).alias("top1"), share(5).alias("top5"),
    )


@query("""
WITH c AS (SELECT label, embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id IN (SELECT min(vec_id) FROM embeddings WHERE embedding IS NOT NULL AND label IS NOT NULL GROUP BY label)),
s AS (SELECT e.vec_id, max(list_cosine_similarity(e.embedding::DOUBLE[], c.v)) FILTER (WHERE c.label = e.label) AS own, max(list_cosine_similarity(e.embedding::DOUBLE[], c.v)) FILTER (WHERE c.label <> e.label) AS other
 FROM embeddings e CROSS JOIN c WHERE e.label IS NOT NULL AND e.embedding IS NOT NULL GROUP BY e.vec_id)
SELECT count(*) AS n, round(avg(own), 6) AS own, round(avg(CAST(own > other AS INT)), 6) AS top1, round(avg(own - other), 6) AS margin FROM s""")
def synonym_test(t):
    first = t.embeddings.filter("embedding IS NOT NULL AND label IS NOT NULL").groupBy("label").agg(F.min_by("embedding", "vec_id").alias("centroid"))
    scores = M.match_margins(t.embeddings, "vec_id", "label", "embedding", first)
    return scores.agg(F.count("*").alias("n"), r6(F.avg("own")).alias("own"), r6(F.avg(F.col("hit").cast("int"))).alias("top1"), r6(F.avg("margin")).alias("margin"))


@query("""
WITH c AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings)
SELECT a.vec_id, list_cosine_similarity(a.v, b.v) > list_cosine_similarity(a.v, c.v) AS told_apart FROM c a JOIN c b ON b.vec_id = a.vec_id + 1 JOIN c c ON c.vec_id = a.vec_id + 2""")
def discriminators(t):
    side = lambda s, k: t.embeddings.select((F.col("vec_id") - k).alias("vec_id"), F.col("embedding").alias(s))
    rows = side("term", 0).join(side("good", 1), "vec_id").join(side("bad", 2), "vec_id")
    return rows.select("vec_id", (V.cosine(F.col("term"), F.col("good")) > V.cosine(F.col("term"), F.col("bad"))).alias("told_apart"))


@query("SELECT round(sum(s) / 20, 6) AS tail_mean FROM (SELECT c_acctbal AS s FROM customer WHERE c_acctbal IS NOT NULL ORDER BY s LIMIT 20)")
def lowest_scores(t):
    return P.tail_mean(t.customer, "c_acctbal").select(r6("tail_mean").alias("tail_mean"))


@query()
def word_substitutions(t):
    words = lambda c: T.recognised_words(c)
    return P.word_substitutions(graph.spread(t.documents.select("doc_id", "text")), "doc_id", words(F.col("text")), words(F.translate("text", "qzx", "gsk")))
