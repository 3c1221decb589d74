"""Gates, order of work, positions, pools, answers and references."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import answers as A
from ..operators import gates as G
from ..operators import sampling as S
from .catalog import query
from .theme_queries import r6

#: Names whose grams a task counts.
NAMES_A_PART = 8192
_SHUFFLED = "md5('42:' || {})"


@query("SELECT doc_id, length(coalesce(text, '')) AS n FROM documents JOIN labels USING (doc_id) WHERE quality = 1 AND (nullif(toxic, 0) IS NULL)")
def cluster_input(t):
    rows = t.documents.join(t.labels, "doc_id").withColumn("error", F.when(F.col("toxic") != 0, "toxic").otherwise(""))
    return G.for_clustering(rows, F.col("quality") == 1, F.col("error"), "text").select("doc_id", F.length("text").cast("long").alias("n"))


@query("SELECT page_id FROM pages WHERE url LIKE '%/en/%' AND ((html IS NOT NULL AND html <> '') OR url IS NOT NULL)")
def embedding_input(t):
    return G.for_embedding(t.pages, F.contains("url", F.lit("/en/")), F.col("html"), F.col("url")).select("page_id")


@query("SELECT doc_id FROM documents JOIN labels USING (doc_id) WHERE quality IN (0, 1) AND text IS NOT NULL AND text <> '' AND doc_id NOT IN (SELECT vec_id FROM embeddings WHERE vec_id IS NOT NULL)")
def embed_gate(t):
    known = t.embeddings.select(F.col("vec_id").alias("doc_id"))
    return G.quality_gate(t.documents.join(t.labels, "doc_id"), "quality", "text", known, "doc_id", (0, 1)).select("doc_id")


@query(r"SELECT doc_id FROM documents LEFT JOIN labels USING (doc_id) WHERE coalesce(quality, 0) <> 1 AND length(trim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))) >= 100")
def summary_gate(t):
    return G.for_summary(t.documents.join(t.labels, "doc_id", "left"), F.col("quality") == 1, F.col("text")).select("doc_id")


@query("SELECT p_partkey, p_type FROM part WHERE lower(p_type) LIKE '%eco%' OR lower(p_type) LIKE '%prom%' OR lower(p_type) LIKE '%med%'")
def family_filter(t):
    return t.part.filter(G.of_family(F.col("p_type"), ["eco", "prom", "med"])).select("p_partkey", "p_type")


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE ((l_discount >= 0.05 AND l_returnflag <> 'N') OR l_quantity = 40) AND length(l_linestatus) >= 1")
def sample_predicate(t):
    keep = G.worth_sampling(F.col("l_discount"), F.col("l_returnflag") == "N", F.col("l_quantity"), F.col("l_linestatus"), 0.05, 1, override=40)
    return t.lineitem.filter(keep).select("l_orderkey", "l_linenumber", "l_partkey")


@query("SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS i FROM orders) WHERE i % 10 < 6")
def position_shard(t):
    return G.by_position(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate", "o_orderkey").select("o_orderkey")


@query(r"SELECT page_id FROM pages WHERE url LIKE '%\_%' ESCAPE '\' OR url LIKE '%\%%' ESCAPE '\'")
def like_escape(t):
    return t.pages.filter(r"url LIKE '%|_%' ESCAPE '|' OR url LIKE '%|%%' ESCAPE '|'").select("page_id")


@query("SELECT doc_id, lang FROM documents WHERE lang NOT IN ('', 'en', 'fr')")
def not_in_literals(t):
    return t.documents.filter(~F.col("lang").isin("", "en", "fr")).select("doc_id", "lang")


@query("SELECT coalesce(quality, -1) AS grade, coalesce(source, 'none') AS origin, doc_id FROM documents LEFT JOIN labels USING (doc_id)")
def fill_rename_reorder(t):
    rows = t.documents.join(t.labels, "doc_id", "left").fillna(-1, ["quality"]).fillna("none", ["source"])
    return rows.withColumnsRenamed({"quality": "grade", "source": "origin"}).select("grade", "origin", "doc_id")


@query("SELECT p_type, p_name, row_number() OVER (ORDER BY CASE lower(p_type) WHEN 'pdf' THEN 0 WHEN 'word' THEN 1 WHEN 'excel' THEN 2 WHEN 'image' THEN 3 WHEN 'xml' THEN 4 ELSE 5 END, p_name, p_type) - 1 AS position FROM (SELECT DISTINCT CASE p_type WHEN 'ECONOMY' THEN 'pdf' WHEN 'PROMO' THEN 'XML' WHEN 'SMALL' THEN 'image' ELSE p_type END AS p_type, p_name FROM part)")
def kind_order(t):
    kind = F.when(F.col("p_type") == "ECONOMY", "pdf").when(F.col("p_type") == "PROMO", "XML").when(F.col("p_type") == "SMALL", "image").otherwise(F.col("p_type"))
    rows = t.part.select(kind.alias("p_type"), "p_name").distinct().withColumn("rank", G.kind_rank(F.col("p_type")))
    return G.numbered(rows, "rank", "p_name", "p_type").select("p_type", "p_name", "position")


@query("SELECT DISTINCT p_brand FROM part WHERE p_name ILIKE '%RING%' OR p_type ILIKE '%eco%'")
def path_predicate(t):
    return t.part.filter(F.col("p_name").ilike("%RING%") | F.col("p_type").ilike("%eco%")).select("p_brand").distinct()


@query("SELECT s.source, coalesce(g.n, 0) AS n, l.n AS n_langs FROM (SELECT DISTINCT source FROM documents) s JOIN (SELECT source, count(DISTINCT lang) AS n FROM documents GROUP BY source) l ON s.source = l.source LEFT JOIN (SELECT source, count(*) AS n FROM documents JOIN labels USING (doc_id) WHERE toxic = 1 GROUP BY source) g ON s.source = g.source")
def inner_and_left(t):
    langs = t.documents.groupBy("source").agg(F.count_distinct("lang").alias("n_langs"))
    toxic = t.documents.join(t.labels.filter("toxic = 1"), "doc_id").groupBy("source").agg(F.count("*").alias("n"))
    return t.documents.select("source").distinct().join(langs, "source").join(toxic, "source", "left").select("source", F.coalesce("n", F.lit(0)).alias("n"), "n_langs")


@query(f"SELECT DISTINCT doc_id FROM (SELECT * FROM (SELECT doc_id FROM documents WHERE lang = 'de' ORDER BY {_SHUFFLED.format('doc_id')}, doc_id LIMIT 20) UNION ALL SELECT * FROM (SELECT doc_id FROM documents WHERE n_chars > 500 ORDER BY {_SHUFFLED.format('doc_id')}, doc_id LIMIT 30) UNION ALL SELECT * FROM (SELECT doc_id FROM documents WHERE lang <> 'en' ORDER BY {_SHUFFLED.format('doc_id')}, doc_id LIMIT 25))")
def strata_sample(t):
    strata = (("lang = 'de'", 20), ("n_chars > 500", 30), ("lang <> 'en'", 25))
    parts = [S.sample(t.documents.filter(c).select("doc_id"), "doc_id", n) for c, n in strata]
    return parts[0].union(parts[1]).union(parts[2]).dropDuplicates(["doc_id"])


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50")
def last_runs(t):
    return G.last_runs(t.orders, "o_totalprice", 50, ("o_totalprice", "o_orderdate"), "o_orderkey").select("o_orderkey", "o_totalprice")


@query("WITH p AS (SELECT doc_id, source AS label, 0 AS part FROM documents UNION ALL SELECT doc_id, lang AS label, 1 AS part FROM documents JOIN labels USING (doc_id) WHERE quality = 0), l AS (SELECT doc_id, arg_max(label, part) AS label FROM p GROUP BY doc_id) SELECT doc_id, label FROM l WHERE label IN (SELECT lang FROM documents UNION SELECT source FROM documents WHERE lang = 'en') AND doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def pool_build(t):
    docs = t.documents
    first = docs.select("doc_id", F.col("source").alias("label"))
    second = docs.join(t.labels.filter("quality = 0"), "doc_id").select("doc_id", F.col("lang").alias("label"))
    known = docs.select(F.col("lang").alias("label")).union(docs.filter("lang = 'en'").select("source"))
    return G.pooled([first, second], "doc_id", "label", known, t.labels.filter("toxic = 1")).select("doc_id", "label")


@query("WITH r AS (SELECT l_orderkey, l_linenumber, l_returnflag AS folder, CASE WHEN l_quantity > 30 THEN 'R' ELSE l_returnflag END AS e, CAST(l_quantity AS INTEGER) % 11 AS votes, CASE WHEN l_linestatus = 'F' THEN 'R' END AS name, l_returnflag AS judge FROM lineitem), a AS (SELECT *, CASE WHEN NOT (e <> folder AND votes >= 9) THEN 'keep' WHEN coalesce(name = e, FALSE) OR coalesce(judge = e, FALSE) THEN 'relabel' ELSE 'delete' END AS action FROM r) SELECT action, CASE action WHEN 'keep' THEN folder WHEN 'relabel' THEN e END AS label, count(*) AS n FROM a GROUP BY ALL")
def label_cleaning(t):
    q = F.col("l_quantity")
    folder, ensemble = F.col("l_returnflag"), F.when(q > 30, "R").otherwise(F.col("l_returnflag"))
    out = G.cleaned_labels(t.lineitem, folder, ensemble, q.cast("int") % 11, F.when(F.col("l_linestatus") == "F", "R"), folder)
    return out.groupBy("action", "label").agg(F.count("*").alias("n"))


@query("SELECT min(label) FILTER (WHERE n < 60) AS resume_at FROM (SELECT label, count(*) AS n FROM embeddings GROUP BY label)")
def resume_point(t):
    n = t.embeddings.groupBy("label").agg((F.count("*") >= 60).alias("done"))
    return G.resume_point(n, "label", "done")


@query("SELECT p_partkey, CASE WHEN p_type IN ('ECONOMY', 'PROMO') THEN 'cheap|common' WHEN p_size > 30 THEN 'large' END AS topics FROM part")
def array_assign(t):
    topics = F.when(F.col("p_type").isin("ECONOMY", "PROMO"), F.array(F.lit("cheap"), F.lit("common"))).when(F.col("p_size") > 30, F.array(F.lit("large")))
    return t.part.select("p_partkey", F.array_join(topics, "|").alias("topics"))


@query("SELECT source, count(*) AS n FROM documents WHERE n_chars > 200 GROUP BY source HAVING count(*) > 1")
def temporary_table(t):
    rows = t.documents.filter("n_chars > 200")
    rows.createOrReplaceTempView("_long_documents")
    out = t.spark.sql("SELECT source, count(*) AS n FROM _long_documents GROUP BY source HAVING count(*) > 1")
    t.spark.catalog.dropTempView("_long_documents")
    return out


@query(r"SELECT doc_id, array_to_string(list_slice(list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda w: w <> ''), 1, 6), ' ') AS title FROM documents")
def theme_catalogue(t):
    return t.documents.select("doc_id", A.first_words(F.col("text"), 6).alias("title"))


@query("SELECT event_id, event_type AS name, CASE WHEN event_id % 3 = 0 THEN 'number' WHEN event_id % 3 = 1 THEN 'json' ELSE 'text' END AS kind FROM events")
def parameters(t):
    k = F.col("event_id") % 3
    value = F.when(k == 0, F.col("event_id").cast("string")).when(k == 1, F.col("props")).otherwise(F.concat(F.lit("v "), F.col("event_type")))
    p = A.parameter(F.concat(F.col("event_type"), F.lit("="), value))
    return t.events.select("event_id", p["name"].alias("name"), p["kind"].alias("kind"))


_REGIONS = {"asia": "A", "europe": "E"}
_CODES = {"10": "X", "12": "Y", "14": "Z"}


@query("SELECT c_custkey, coalesce(CASE WHEN lower(trim(r_name)) = 'asia' THEN 'A' WHEN lower(trim(r_name)) = 'europe' THEN 'E' END, CASE substr(CAST(c_custkey AS VARCHAR), 1, 2) WHEN '10' THEN 'X' WHEN '12' THEN 'Y' WHEN '14' THEN 'Z' END, CASE substr(CAST(c_nationkey AS VARCHAR), 1, 2) WHEN '10' THEN 'X' WHEN '12' THEN 'Y' WHEN '14' THEN 'Z' END) AS region FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def region_alias(t):
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    code = lambda c: F.col(c).cast("string")
    return rows.select("c_custkey", A.aliased(F.col("r_name"), [code("c_custkey"), code("c_nationkey")], _REGIONS, _CODES).alias("region"))


@query("SELECT doc_id, substr(coalesce(CASE WHEN length(s) >= 15 THEN s END, text), 1, 600) AS subject FROM (SELECT doc_id, text, substr(array_to_string(list_transform(list_slice(list_filter(string_split(text, chr(10)), lambda x: contains(lower(x), 'that') OR contains(lower(x), 'dans')), 1, 6), lambda x: trim(regexp_replace(x, '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g'))), '; '), 1, 600) AS s FROM documents)".replace("\\\\", "\\"))
def subject_or_text(t):
    subject = A.subject_lines(F.col("text"), ["that", "dans"])
    return t.documents.select("doc_id", F.substring(F.coalesce(subject, F.col("text")), 1, 600).alias("subject"))


@query("WITH w AS (SELECT p_partkey, unnest(list_filter(string_split(lower(p_name), ' '), lambda x: x <> '')) AS w FROM part), p AS (SELECT p_partkey, ' ' || w || ' ' AS w FROM w), g AS (SELECT p_partkey, substr(md5(substr(w, CAST(i AS BIGINT), CAST(n AS BIGINT))), 1, 3) AS b FROM p, range(1, 60) t(i), range(3, 6) s(n) WHERE i <= length(w) - n + 1) SELECT p_partkey, b AS bucket, count(*) AS n FROM g GROUP BY ALL")
def char_gram_vector(t):
    # Names are dealt by key, so many to a part, before they are cut: a few tasks read a table of any size, and would count all its grams.
    parts = max(t.spark.sparkContext.defaultParallelism, -(-t.part.count() // NAMES_A_PART))
    names = t.part.select("p_partkey", "p_name").repartition(parts, "p_partkey")
    return names.select("p_partkey", F.explode(A.gram_buckets(F.col("p_name"))).alias("bucket")).groupBy("p_partkey", "bucket").agg(F.count("*").alias("n"))
