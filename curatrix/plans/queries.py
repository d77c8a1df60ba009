"""The catalogue: every operator over the driver's tables, with its SQL where SQL can say it."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.nulls import holds
from ..functions.schema import align, column_range, union
from ..functions.text import as_list, has_content, joined_text, message, stamp, strip_markup, too_long, words
from ..operators import classify, curate, kernel, labels, names, review, search, splits, verdicts
from ..sources import connectors
from ..sources.store import deleted, updated

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

#: Words that the invented texts hold, as search phrases.
PHRASES = '("the and" OR "of the") AND ("that" OR "with")'


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- scans, search, text ------------------------------------------------------------------------


@query("""
SELECT doc_id, source FROM documents
WHERE n_chars BETWEEN 100 AND 1000000
  AND (contains(lower(text), 'the and') OR contains(lower(text), 'of the')) AND (contains(lower(text), 'that') OR contains(lower(text), 'with'))
""")
def search_boolean_phrases(spark, d):
    return connectors.by_phrases(table(spark, d, "documents"), [PHRASES], ("text",), "n_chars", 100, 1_000_000).select("doc_id", "source")


@query("""
WITH results AS (
  SELECT *, 0 AS q FROM documents WHERE contains(lower(text), 'the and')
  UNION ALL SELECT *, 1 AS q FROM documents WHERE contains(lower(text), 'que'))
SELECT doc_id, lang, CAST(q AS INTEGER) AS found_by
FROM results QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY q) = 1
""")
def union_dedup_first(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "text")
    parts = [docs.where(search.matches(f'"{p}"', "text")).withColumn("found_by", F.lit(n)) for n, p in enumerate(("the and", "que"))]
    return curate.first_of_each(union(*parts), ["doc_id"], [F.asc("found_by")]).select("doc_id", "lang", "found_by")


@query("SELECT page_id, regexp_replace(html, '<[^>]*>', '', 'g') AS plain FROM pages")
def strip_markup_pages(spark, d):
    return table(spark, d, "pages").select("page_id", strip_markup("html").alias("plain"))


@query(r"""
SELECT doc_id FROM documents
WHERE list_has_any(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> ''), ['the', 'que', 'und'])
   OR text IS NULL OR len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')) = 0
""")
def code_overlap_filter(spark, d):
    docs = table(spark, d, "documents").select("doc_id", words("text").alias("codes"))
    return docs.where(search.code_or_none("codes", ["the", "que", "und"])).select("doc_id")


@query("""
SELECT p_partkey, p_brand FROM part
WHERE p_size BETWEEN 5 AND 30 AND list_has_any([p_brand, p_type], ['Brand#11', 'Brand#22', 'Brand#33'])
""")
def search_by_codes(spark, d):
    rows = table(spark, d, "part").withColumn("codes", F.array("p_brand", "p_type"))
    return connectors.by_codes(rows, ["Brand#11", "Brand#22", "Brand#33"], "codes", "p_size", 5, 30).select("p_partkey", "p_brand")


@query("""
SELECT conv_id, turn, concat('Title: ', coalesce(role, 'None'), chr(10), chr(10), 'Abstract: ', coalesce(text, 'None')) AS message
FROM conversations WHERE role = 'user'
""")
def request_messages(spark, d):
    return table(spark, d, "conversations").where(F.col("role") == "user").select("conv_id", "turn", message("role", "text").alias("message"))


@query("SELECT doc_id, coalesce(len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')) > 512, false) AS truncated FROM documents")
def token_flag(spark, d):
    return table(spark, d, "documents").select("doc_id", too_long("text").alias("truncated"))


@query("SELECT doc_id, length(concat(coalesce(source, ''), ' [SEP] ', coalesce(text, ''))) AS n, coalesce(source <> '', false) AND coalesce(text <> '', false) AS full_record FROM documents")
def encoder_text(spark, d):
    return table(spark, d, "documents").select("doc_id", F.length(joined_text("source", "text")).cast("long").alias("n"), has_content("source", "text").alias("full_record"))


@query("SELECT event_id, strftime(ts, '%y%m%d') AS day FROM events")
def date_stamp(spark, d):
    return table(spark, d, "events").select("event_id", stamp(F.col("ts")).alias("day"))


@query("SELECT event_id, concat('{\"event_type\":\"', event_type, '\",\"user_id\":', user_id, '}') AS body FROM events")
def json_serialise(spark, d):
    return table(spark, d, "events").select("event_id", F.to_json(F.struct("event_type", "user_id")).alias("body"))


# --- versions, representatives, joins -----------------------------------------------------------


@query("""
SELECT o_orderkey, o_custkey, o_orderpriority FROM orders
WHERE o_custkey IS NOT NULL AND o_orderpriority IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate DESC NULLS LAST, o_orderstatus DESC NULLS LAST, o_orderkey) = 1
""")
def latest_version_per_key(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate", "o_orderstatus")
    return curate.latest_versions(orders, ["o_custkey", "o_orderpriority"], ["o_orderdate", "o_orderstatus"], "o_orderkey").select("o_orderkey", "o_custkey", "o_orderpriority")


REPRESENTATIVE = """
(coalesce(source <> '', false) AND coalesce(text <> '', false)) DESC,
(coalesce(source <> '', false) AND coalesce(text <> '', false) AND coalesce(lang IN ('en', 'de'), false)) DESC, n_chars DESC NULLS LAST, doc_id"""


@query(f"SELECT doc_id, source, lang, n_chars FROM documents WHERE source IS NOT NULL QUALIFY row_number() OVER (PARTITION BY source ORDER BY {REPRESENTATIVE}) = 1")
def representative_per_family(spark, d):
    docs = table(spark, d, "documents")
    return curate.representatives(docs, ["source"], ("source", "text"), "lang", ("en", "de"), "n_chars", "doc_id").select("doc_id", "source", "lang", "n_chars")


@query("""
WITH labelled AS (SELECT d.*, coalesce(CASE WHEN d.doc_id % 3 = 0 THEN NULL ELSE d.source END, CAST(d.doc_id AS VARCHAR)) AS group_key, CASE WHEN l.toxic = 1 THEN 'F' ELSE 'PB' END AS pillar
  FROM documents d JOIN labels l USING (doc_id))
SELECT doc_id, group_key, pillar FROM labelled
QUALIFY row_number() OVER (PARTITION BY group_key, pillar ORDER BY (coalesce(text <> '', false)) DESC, (coalesce(text <> '', false) AND coalesce(lang IN ('en', 'de'), false)) DESC, n_chars DESC NULLS LAST, doc_id) = 1
""")
def representative_per_family_pillar(spark, d):
    rows = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id")
    rows = rows.withColumn("family", F.when(F.col("doc_id") % 3 != 0, F.col("source"))).withColumn("group_key", curate.group_key("family", "doc_id"))
    rows = rows.withColumn("pillar", F.when(F.col("toxic") == 1, "F").otherwise("PB"))
    return curate.representatives(rows, ["group_key", "pillar"], ("text",), "lang", ("en", "de"), "n_chars", "doc_id").select("doc_id", "group_key", "pillar")


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def antijoin_existing(spark, d):
    return curate.unseen(table(spark, d, "documents").select("doc_id", "source"), table(spark, d, "labels"), "doc_id")


@query("SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL) AS is_known FROM customer")
def known_new_split(spark, d):
    return curate.split_known(table(spark, d, "customer").select("c_custkey"), table(spark, d, "orders").withColumnRenamed("o_custkey", "c_custkey"), "c_custkey").select("c_custkey", "is_known")


SUPERSEDE = """
WITH stored AS (SELECT *, year(o_orderdate) AS y FROM orders WHERE o_orderkey % 2 = 0),
incoming AS (SELECT *, year(o_orderdate) AS y FROM orders WHERE o_orderkey % 2 = 1),
newest AS (SELECT o_custkey, o_orderpriority, max(y) AS s FROM stored GROUP BY ALL),
offered AS (SELECT o_custkey, o_orderpriority, max(y) AS o FROM incoming GROUP BY ALL)
SELECT o_orderkey, 'stays' AS what FROM stored t WHERE NOT EXISTS (SELECT 1 FROM newest n, offered f WHERE n.o_custkey IS NOT DISTINCT FROM t.o_custkey AND n.o_orderpriority IS NOT DISTINCT FROM t.o_orderpriority AND f.o_custkey IS NOT DISTINCT FROM t.o_custkey AND f.o_orderpriority IS NOT DISTINCT FROM t.o_orderpriority AND f.o > n.s)
UNION ALL
SELECT o_orderkey, 'enters' FROM incoming t LEFT JOIN newest n ON n.o_custkey IS NOT DISTINCT FROM t.o_custkey AND n.o_orderpriority IS NOT DISTINCT FROM t.o_orderpriority WHERE n.s IS NULL OR t.y > n.s
"""


@query(SUPERSEDE)
def version_supersession(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", F.year("o_orderdate").alias("y"))
    rows = curate.superseded(orders.where("o_orderkey % 2 = 0"), orders.where("o_orderkey % 2 = 1"), ["o_custkey", "o_orderpriority"], "y").where("passes")
    return rows.select(F.coalesce("stored.o_orderkey", "incoming.o_orderkey").alias("o_orderkey"), F.when(F.col("stored").isNotNull(), "stays").otherwise("enters").alias("what"))


@query("""
SELECT o_custkey, CAST(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS INTEGER) AS pred, o_orderkey FROM orders WHERE o_custkey IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey) = 1
""")
def distinct_on_family(spark, d):
    rows = curate.latest_versions(table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"), ["o_custkey"], ["o_orderdate"], "o_orderkey")
    return rows.select("o_custkey", F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("pred"), "o_orderkey")


@query("""
WITH decided AS (SELECT source, l.toxic FROM documents d JOIN labels l USING (doc_id) WHERE source IS NOT NULL QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) = 1)
SELECT doc_id, source, toxic FROM documents LEFT JOIN decided USING (source)
""")
def propagate_predictions(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source")
    decided = docs.join(table(spark, d, "labels"), "doc_id")
    return curate.propagate(docs, decided, "source", ["toxic"], [F.asc("doc_id")]).select("doc_id", "source", "toxic")


@query("""
SELECT c_custkey, c_name, CAST(coalesce(n, 0) AS BIGINT) AS members FROM customer LEFT JOIN
 (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'F' AND year(o_orderdate) BETWEEN 1993 AND 1996 GROUP BY o_custkey) ON c_custkey = o_custkey
""")
def reverse_search_members(spark, d):
    orders = table(spark, d, "orders").withColumn("y", F.year("o_orderdate")).where("o_orderstatus = 'F'")
    customers = table(spark, d, "customer")
    found = connectors.by_keys(orders, customers.withColumnRenamed("c_custkey", "o_custkey"), "o_custkey", "y", 1993, 1996).groupBy("o_custkey").agg(F.count("*").alias("n"))
    return customers.join(found, customers.c_custkey == found.o_custkey, "left").select("c_custkey", "c_name", F.coalesce("n", F.lit(0)).alias("members"))


@query("""
SELECT o_custkey AS id, CAST(sum(round(o_totalprice * 100)) AS BIGINT) AS total FROM orders WHERE o_custkey IS NOT NULL
GROUP BY o_custkey ORDER BY total DESC, id LIMIT 500
""")
def top_k_keys(spark, d):
    orders = table(spark, d, "orders").select(F.col("o_custkey").alias("id"), F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))
    return curate.top_keys(orders, ["id"], "cents", 500)


@query("""
WITH people AS (SELECT l_partkey AS id, count(*) AS n FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT') GROUP BY 1 ORDER BY n DESC, id LIMIT 500)
SELECT DISTINCT l_orderkey FROM lineitem WHERE l_partkey IN (SELECT id FROM people)
""")
def reverse_search_researchers(spark, d):
    """Top contributors of the relevant records, then every record one of them is part of."""
    items = table(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    relevant = table(spark, d, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("l_orderkey"))
    people = curate.top_keys(items.join(relevant, "l_orderkey", "left_semi").select(F.col("l_partkey").alias("id"), F.lit(1).alias("one")), ["id"], "one", 500)
    return items.join(F.broadcast(people.select(F.col("id").alias("l_partkey"))), "l_partkey", "left_semi").select("l_orderkey").distinct()  # at most 500 rows


# --- tables -------------------------------------------------------------------------------------


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'reviewed' ELSE o_orderstatus END AS o_orderstatus, CASE WHEN o_orderkey % 5 = 0 THEN c_mktsegment END AS reviewer
FROM orders LEFT JOIN customer ON o_custkey = c_custkey
""")
def keyed_update(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    source = orders.where("o_orderkey % 5 = 0").join(table(spark, d, "customer").withColumnRenamed("c_custkey", "o_custkey"), "o_custkey", "left")
    source = source.select("o_orderkey", F.lit("reviewed").alias("o_orderstatus"), F.col("c_mktsegment").alias("reviewer"))
    return updated(orders, source, "o_orderkey", ["o_orderstatus", "reviewer"]).select("o_orderkey", "o_orderstatus", "reviewer")


@query("""
SELECT o_orderkey, CASE WHEN c_custkey IS NOT NULL THEN c_mktsegment ELSE o_orderpriority END AS o_orderpriority
FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey
""")
def group_update(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    source = table(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("o_orderpriority"))
    return updated(orders, source, "o_custkey", ["o_orderpriority"]).select("o_orderkey", "o_orderpriority")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def keyed_delete(spark, d):
    gone = table(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return deleted(table(spark, d, "orders").select("o_orderkey", "o_custkey"), gone, "o_custkey")


@query("""
WITH source AS (SELECT o_custkey, strftime(max(o_orderdate), '%y%m%d') AS day FROM orders GROUP BY o_custkey),
target AS (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN '950101' END AS day FROM customer)
SELECT c_custkey, CASE WHEN o_custkey IS NULL THEN t.day ELSE greatest(coalesce(t.day, s.day), s.day) END AS day FROM target t LEFT JOIN source s ON c_custkey = o_custkey
""")
def merge_max_date(spark, d):
    target = table(spark, d, "customer").select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, "950101").alias("day"))
    source = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(stamp(F.max("o_orderdate")).alias("day"))
    return updated(target, source, "c_custkey", ["day"], merge_max=("day",))


@query("""
SELECT p_partkey AS id, p_name AS name, p_retailprice AS amount, CAST(NULL AS INTEGER) AS nation FROM part
UNION ALL SELECT s_suppkey, s_name, s_acctbal, s_nationkey FROM supplier
""")
def schema_align_union(spark, d):
    a = table(spark, d, "part").selectExpr("p_partkey AS id", "p_name AS name", "p_retailprice AS amount", "p_size AS extra")
    b = table(spark, d, "supplier").selectExpr("s_suppkey AS id", "s_name AS name", "s_acctbal AS amount", "s_nationkey AS nation")
    target = b.schema
    return union(align(a, target), align(b, target))


@query("SELECT l_orderkey, l_quantity, l_extendedprice, l_discount FROM lineitem")
def column_slice(spark, d):
    rows = table(spark, d, "lineitem")
    return column_range(rows.select("l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"), "l_orderkey", "l_discount")


# --- reports ------------------------------------------------------------------------------------


@query("SELECT lang, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY lang")
def value_counts_report(spark, d):
    return curate.value_counts(table(spark, d, "documents"), "lang")


@query("""
SELECT o_orderpriority, count(*) AS n, count(DISTINCT o_custkey) AS families, round(avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END), 6) AS share,
  CAST(count_if(o_totalprice > 100000) AS BIGINT) AS large FROM orders GROUP BY o_orderpriority
""")
def ratio_report(spark, d):
    return table(spark, d, "orders").groupBy("o_orderpriority").agg(
        F.count("*").alias("n"),
        F.countDistinct("o_custkey").alias("families"),
        F.round(F.avg(holds(F.col("o_orderstatus") == "F").cast("double")), 6).alias("share"),
        F.count_if(F.col("o_totalprice") > 100000).alias("large"),
    )


# --- classifiers --------------------------------------------------------------------------------


@query("""
WITH scored AS (SELECT d.doc_id, l.quality AS label, (d.n_chars % 1000) / 1000.0::DOUBLE AS proba FROM documents d JOIN labels l USING (doc_id)),
sweep AS (SELECT t / 1000.0::DOUBLE AS threshold, (SELECT count(*) FROM scored WHERE label = 1 AND proba < t / 1000.0::DOUBLE) AS fn, (SELECT count(*) FROM scored) AS n FROM range(0, 1001) r(t))
SELECT threshold, fn AS false_negatives FROM sweep WHERE fn / n < 0.01 ORDER BY threshold DESC LIMIT 1
""")
def fn_threshold_sweep(spark, d):
    rows = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id").select(F.col("quality").alias("label"), ((F.col("n_chars") % 1000) / F.lit(1000.0)).alias("proba"))
    return classify.fn_threshold(rows, max_fn=0.01)


@query("""
SELECT doc_id, CAST((CASE WHEN pillar IS DISTINCT FROM 'NA' OR coalesce(toxic = 1, false) THEN 1 ELSE 0 END) AS INTEGER) AS pred_combined
FROM (SELECT doc_id, toxic, CASE doc_id % 3 WHEN 0 THEN 'NA' WHEN 1 THEN 'PB' END AS pillar FROM labels)
""")
def combine_predictions(spark, d):
    rows = table(spark, d, "labels").withColumn("pillar", F.when(F.col("doc_id") % 3 == 0, "NA").when(F.col("doc_id") % 3 == 1, "PB"))
    return rows.select("doc_id", classify.combine("pillar", "toxic").alias("pred_combined"))


HASHED = "CAST('0x' || md5('42:' || id)[1:15] AS BIGINT) AS key"


@query(f"""
WITH rows AS (SELECT *, {HASHED} FROM (SELECT o_orderkey, o_orderpriority, CAST(o_orderkey AS VARCHAR) AS id FROM orders)),
sizes AS (SELECT o_orderpriority AS p, count(*) AS n FROM rows GROUP BY 1), total AS (SELECT sum(n) AS n, CAST(ceil(round(0.2 * sum(n), 9)) AS HUGEINT) AS wanted FROM sizes),
shares AS (SELECT p, s.n, s.n * wanted // t.n AS base, wanted - sum(s.n * wanted // t.n) OVER () AS spare, row_number() OVER (ORDER BY s.n * wanted % t.n DESC, s.n DESC, p NULLS FIRST) AS place FROM sizes s, total t),
ranked AS (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY key, id) AS r FROM rows)
SELECT o_orderkey, o_orderpriority, r <= base + CASE WHEN place <= spare THEN 1 ELSE 0 END AS is_test FROM ranked JOIN shares ON p IS NOT DISTINCT FROM o_orderpriority
""")
def train_test_split(spark, d):
    return splits.split(table(spark, d, "orders").select("o_orderkey", "o_orderpriority"), "o_orderkey", 0.2, "o_orderpriority")


@query(f"""
WITH rows AS (SELECT *, {HASHED} FROM (SELECT event_id, CAST(event_id AS VARCHAR) AS id FROM events))
SELECT event_id, row_number() OVER (ORDER BY key, id) <= CAST(ceil(round(0.25 * count(*) OVER (), 9)) AS BIGINT) AS is_test FROM rows
""")
def train_test_split_plain(spark, d):
    return splits.split(table(spark, d, "events").select("event_id"), "event_id", 0.25)


@query(f"""
WITH rows AS (SELECT *, {HASHED} FROM (SELECT l_orderkey, l_linenumber, l_returnflag, l_orderkey || '-' || l_linenumber AS id FROM lineitem))
SELECT l_orderkey, l_linenumber, l_returnflag, CAST((row_number() OVER (PARTITION BY l_returnflag ORDER BY key, id) - 1) % 5 AS INTEGER) AS fold FROM rows
""")
def stratified_folds(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", F.concat("l_orderkey", F.lit("-"), "l_linenumber").alias("id"))
    return splits.folds(rows, "id", "l_returnflag", 5).drop("id")


WEIGHTS = [((7 * i) % 11 - 5) / 10 for i in range(64)]


@query(f"""
SELECT vec_id, round(s, 4) AS score, CASE WHEN round(s, 4) >= 0.0 THEN 'in' ELSE 'out' END AS pred
FROM (SELECT vec_id, list_dot_product(CAST(embedding AS DOUBLE[]), {WEIGHTS}::DOUBLE[]) AS s FROM embeddings)
""")
def embed_score_linear(spark, d):
    rows = table(spark, d, "embeddings").select("vec_id", F.round(classify.linear_score("embedding", WEIGHTS), 4).alias("score")).withColumn("flag", (F.col("score") >= 0).cast("int"))
    return rows.select("vec_id", "score", classify.in_out("flag").alias("pred"))


@query()
def embed_classify_lr(spark, d):
    """Balanced logistic regression on embeddings: label 0 against the rest, fitted on all rows and applied to them."""
    from pyspark.ml.functions import vector_to_array

    rows = classify.features(table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("embeddings"), (F.col("label") == 0).cast("double").alias("label")))
    model = classify.logistic(rows.where("label is not null"), 0.1)
    return model.transform(rows).select("id", F.round(vector_to_array("probability")[1], 6).alias("proba_scope"))


@query()
def embed_cross_validated(spark, d):
    """The same out of sample: each row by the model of the folds that it is not in."""
    rows = classify.features(table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("embeddings"), (F.col("label") == 0).cast("double").alias("label")))
    return classify.cross_validated(rows.where("label is not null"), lambda part: classify.logistic(part, 0.1)).select("id", F.round("proba", 6).alias("proba_scope"))


@query()
def embed_classify_svm(spark, d):
    """Calibrated kernel machines, label 0 against the rest; the kernel is as wide as the vectors are far apart."""
    rows = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("embeddings"), F.when(F.col("label") == 0, "in").when(F.col("label").isNotNull(), "out").alias("scope"))
    model, _ = kernel.fit(rows, "scope", c=100.0, gamma=0.01, size=128)
    return model.transform(rows).select("id", F.round(F.col("probabilities")[0], 6).alias("proba_scope"))


@query()
def pillar_svm(spark, d):
    """One kernel machine for each of several classes against the rest, calibrated and normalised."""
    pillar = F.when(F.col("label") < 4, F.element_at(F.array(*[F.lit(p) for p in labels.PILLARS]), F.col("label") + 1)).otherwise("NA")
    rows = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("embeddings"), pillar.alias("pillar"))
    model, _ = kernel.fit(rows, "pillar", c=1000.0, gamma=0.01, size=128)
    return model.best(rows, probability="proba_pillar", name="pred_pillar").select("id", "pred_pillar", F.round("proba_pillar", 6).alias("proba_pillar"))


@query()
def classify_pillar(spark, d):
    rows = classify.features(table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("embeddings"), F.when(F.col("label") < 4, F.element_at(F.array(*[F.lit(p) for p in labels.PILLARS]), F.col("label") + 1)).alias("pillar")))
    model = classify.pillar_model(rows)
    return classify.predict_pillar(model, rows).select("id", "pred_pillar", F.round("proba_pillar", 6).alias("proba_pillar"))


@query()
def embed_new_documents(spark, d):
    """Embeddings of documents that have none stored (those with labels count as stored)."""
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "source", "text")
    new = classify.embed_new(docs, table(spark, d, "labels").select(F.col("doc_id").alias("id")), joined_text("source", "text"), classify.hash_encoder)
    return new.select("id", F.transform("embeddings", lambda x: F.round(x.cast("double"), 5)).alias("embeddings"))


# --- verdicts, labels, review -------------------------------------------------------------------


@query("""
SELECT doc_id, CASE WHEN (p::INT + f::INT + c::INT) > 1 OR (x AND (p::INT + f::INT + c::INT) = 0) THEN 'CC' WHEN p THEN 'PB' WHEN f THEN 'F' WHEN c THEN 'CM' ELSE 'NA' END AS pillar
FROM (SELECT doc_id, coalesce(quality = 1, false) AS p, coalesce(toxic = 1, false) AS f, doc_id % 5 = 0 AS c, doc_id % 7 = 0 AS x FROM labels)
""")
def pillar_from_flags(spark, d):
    rows = table(spark, d, "labels").select("doc_id", (F.col("quality") == 1).alias("p"), (F.col("toxic") == 1).alias("f"), (F.col("doc_id") % 5 == 0).alias("c"), (F.col("doc_id") % 7 == 0).alias("x"))
    return rows.select("doc_id", verdicts.pillar_of("p", "f", "c", "x").alias("pillar"))


@query("""
WITH results AS (SELECT event_id, CASE WHEN user_id % 10 = 0 THEN 'errored' ELSE 'succeeded' END AS result_type,
   CASE WHEN event_id % 4 = 0 THEN '{"primary_category": " meat "}' WHEN event_id % 4 = 1 THEN '{"primary_category": "CHEESE", "secondary_category": "none"}' WHEN event_id % 4 = 2 THEN props ELSE 'broken' END AS payload FROM events),
parsed AS (SELECT *, CASE WHEN result_type = 'succeeded' AND payload <> 'broken' THEN lower(trim(json_extract_string(CASE WHEN payload <> 'broken' THEN payload ELSE '{}' END, '$.primary_category'))) END AS p FROM results)
SELECT CAST(event_id AS VARCHAR) AS id, CASE p WHEN 'meat' THEN 'Meat' WHEN 'cheese' THEN 'Cheese' END AS primary_category_LLM, CAST(NULL AS VARCHAR) AS secondary_category_LLM,
  CASE WHEN result_type <> 'succeeded' THEN result_type WHEN p IN ('meat', 'cheese') THEN 'ok' ELSE 'parse_error' END AS category_status_LLM,
  CASE WHEN result_type = 'succeeded' THEN 'tool_use' END AS category_stop_reason_LLM FROM parsed
""")
def verdict_parse_results(spark, d):
    e = table(spark, d, "events")
    payload = F.when(e.event_id % 4 == 0, '{"primary_category": " meat "}').when(e.event_id % 4 == 1, '{"primary_category": "CHEESE", "secondary_category": "none"}').when(e.event_id % 4 == 2, e.props).otherwise("broken")
    results = e.select(F.col("event_id").cast("string").alias("custom_id"), F.when(e.user_id % 10 == 0, "errored").otherwise("succeeded").alias("result_type"), F.lit("tool_use").alias("stop_reason"), payload.alias("payload"))
    return verdicts.parse_labels(results, labels.END_PRODUCTS, "category")


@query("""
SELECT CAST(doc_id AS VARCHAR) AS id, CASE WHEN toxic = 1 THEN 'in' ELSE 'out' END AS "scope_LLM", CAST(1 + doc_id % 7 AS DOUBLE) AS "confidence_LLM",
  quality = 1 AS "plant_based_LLM", false AS "fermentation_LLM", false AS "cultivated_LLM", toxic = 1 AS "cross_cutting_LLM", 'ok' AS "status_LLM", 'tool_use' AS "stop_reason_LLM",
  CASE WHEN quality = 1 THEN 'PB' WHEN toxic = 1 THEN 'CC' ELSE 'NA' END AS "pillar_LLM" FROM labels
""")
def verdict_parse_scope(spark, d):
    rows = table(spark, d, "labels")
    flag = lambda c: F.when(c, "true").otherwise("false")
    payload = F.to_json(
        F.struct(
            F.when(rows.toxic == 1, "in").otherwise("out").alias("scope"), (1 + rows.doc_id % 7).cast("double").alias("confidence"), flag(rows.quality == 1).alias("plant_based"),
            F.lit("no").alias("fermentation"), F.lit("false").alias("cultivated"), flag(rows.toxic == 1).alias("cross_cutting"),
        )
    )
    return verdicts.parse_scope(rows.select(F.col("doc_id").cast("string").alias("custom_id"), F.lit("succeeded").alias("result_type"), F.lit("tool_use").alias("stop_reason"), payload.alias("payload")))


REQUESTS = f"""
SELECT CAST(doc_id AS VARCHAR) AS custom_id, '{{"model":"any-model","max_tokens":512,"temperature":0,"system":[{{"type":"text","text":"Decide whether the document is in scope.","cache_control":{{"type":"ephemeral"}}}}],"tools":[' ||
  '{json.dumps(verdicts.scope_tool(), sort_keys=True, separators=(",", ":"))}' || '],"tool_choice":{{"type":"tool","name":"record_scope"}},"messages":[{{"role":"user","content":' ||
  to_json('Title: ' || coalesce(source, 'None') || chr(10) || chr(10) || 'Abstract: ' || coalesce(text, 'None')) || '}}]}}' AS params FROM documents
"""


@query(REQUESTS)
def verdict_requests(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), "source", "text")
    return verdicts.requests(docs, verdicts.scope_tool(), "any-model", 512, "Decide whether the document is in scope.", "source", "text", "doc_id")


REVIEWED = """
WITH rows AS (SELECT d.doc_id, CASE d.doc_id % 4 WHEN 0 THEN 'in' WHEN 1 THEN 'out' WHEN 2 THEN 'NA' END AS scope_LLM, CAST(CASE WHEN d.doc_id % 9 < 8 THEN d.doc_id % 9 END AS DOUBLE) AS confidence_LLM,
  (d.n_chars % 100) / 100.0::DOUBLE AS proba_scope, CASE d.doc_id % 5 WHEN 0 THEN 'NA' WHEN 1 THEN 'PB' WHEN 2 THEN 'F' WHEN 3 THEN 'CM' END AS pred_pillar,
  CASE d.doc_id % 3 WHEN 0 THEN 'NA' WHEN 1 THEN 'F' END AS pillar_LLM, CASE WHEN l.toxic = 1 THEN 'out' WHEN l.toxic = 0 THEN 'in' END AS pred_combined
  FROM documents d LEFT JOIN labels l USING (doc_id))
"""


def _reviewed(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "n_chars").join(table(spark, d, "labels").select("doc_id", "toxic"), "doc_id", "left")
    i = F.col("doc_id")
    return docs.select(
        "doc_id",
        F.when(i % 4 == 0, "in").when(i % 4 == 1, "out").when(i % 4 == 2, "NA").alias("scope_LLM"),
        F.when(i % 9 < 8, (i % 9).cast("double")).alias("confidence_LLM"),
        ((F.col("n_chars") % 100) / F.lit(100.0)).alias("proba_scope"),
        F.when(i % 5 == 0, "NA").when(i % 5 == 1, "PB").when(i % 5 == 2, "F").when(i % 5 == 3, "CM").alias("pred_pillar"),
        F.when(i % 3 == 0, "NA").when(i % 3 == 1, "F").alias("pillar_LLM"),
        F.when(F.col("toxic") == 1, "out").when(F.col("toxic") == 0, "in").alias("pred_combined"),
    )


@query(
    REVIEWED
    + """, scoped AS (SELECT *, CASE WHEN pred_combined = 'out' THEN 'out'
   WHEN scope_LLM = 'NA' AND pred_combined = 'in' THEN 'manual_review' WHEN scope_LLM = 'in' AND confidence_LLM >= 5 THEN 'in'
   WHEN confidence_LLM <= 4 AND proba_scope > 0.8 AND pred_pillar IS DISTINCT FROM 'NA' THEN 'in'
   WHEN scope_LLM = 'out' AND confidence_LLM = 2 AND proba_scope < 0.6 AND pred_pillar = 'NA' THEN 'out'
   WHEN scope_LLM = 'out' AND confidence_LLM = 1 AND proba_scope < 0.8 THEN 'out' ELSE 'manual_review' END AS scope_curated FROM rows)
SELECT doc_id, scope_curated, CASE WHEN scope_curated <> 'out' THEN coalesce(nullif(pillar_LLM, 'NA'), nullif(pred_pillar, 'NA')) END AS pillar_curated FROM scoped"""
)
def review_rules_patents(spark, d):
    return review.review_patents(_reviewed(spark, d)).select("doc_id", "scope_curated", "pillar_curated")


@query(
    REVIEWED
    + """, marked AS (SELECT *, coalesce(scope_LLM = 'in' AND confidence_LLM > 4 AND pillar_LLM IS DISTINCT FROM 'NA', false)
   OR coalesce(scope_LLM = 'in' AND confidence_LLM = 4 AND pillar_LLM IS DISTINCT FROM 'NA' AND pillar_LLM = pred_pillar, false)
   OR coalesce(scope_LLM = 'out' AND confidence_LLM < 2 AND pillar_LLM = 'NA', false) AS inherit FROM rows)
SELECT doc_id, CASE WHEN pred_combined = 'out' THEN 'out' WHEN inherit THEN scope_LLM ELSE 'manual_review' END AS scope_curated,
  CASE WHEN pred_combined = 'out' THEN NULL WHEN inherit THEN pillar_LLM ELSE 'manual_review' END AS pillar_curated FROM marked"""
)
def review_rules_publications(spark, d):
    return review.review_publications(_reviewed(spark, d)).select("doc_id", "scope_curated", "pillar_curated")


def _classified(spark: SparkSession, d: str) -> DataFrame:
    """Rows as they stand before labelling: curated scope and pillar, statuses, a nested column."""
    docs = table(spark, d, "documents").select("doc_id", "source", "lang").join(table(spark, d, "labels"), "doc_id")
    i = F.col("doc_id")
    return docs.select(
        i.cast("string").alias("id"),
        "source",
        as_list(F.col("lang")).alias("langs"),
        F.when(F.col("quality") == 1, "in").otherwise("out").alias("scope_curated"),
        F.element_at(F.array(*[F.lit(p) for p in ("PB", "F", "CM", "CC")]), (i % 4 + 1).cast("int")).alias("pillar_curated"),
        F.when(i % 6 != 0, "ok").alias("category_status_LLM"),
        F.lit("Other").alias("primary_category_LLM"),
        F.lit(None).cast("string").alias("secondary_category_LLM"),
    )


CLASSIFIED = """
WITH classified AS (SELECT CAST(doc_id AS VARCHAR) AS id, doc_id, source, lang, CASE WHEN quality = 1 THEN 'in' ELSE 'out' END AS scope_curated, ['PB', 'F', 'CM', 'CC'][CAST(doc_id % 4 + 1 AS INTEGER)] AS pillar_curated
  FROM documents JOIN labels USING (doc_id))
"""


@query(CLASSIFIED + """SELECT id, 'NA' AS "primary_subpillar_LLM", 'ok' AS "subpillar_status_LLM" FROM classified WHERE scope_curated = 'in' AND pillar_curated <> 'F'""")
def auto_value_branch(spark, d):
    kind = labels.PATENT_LABELS[3]
    return labels.automatic(labels.eligible(_classified(spark, d), kind), kind).select("id", "primary_subpillar_LLM", "subpillar_status_LLM")


@query(CLASSIFIED + """SELECT id, source, '["' || lang || '"]' AS langs, scope_curated, pillar_curated, 'Other' AS research_category FROM classified WHERE scope_curated = 'in' AND doc_id % 6 <> 0 AND doc_id % 10 <> 1""")
def labelled_assembly(spark, d):
    rows = _classified(spark, d)
    there = rows.where("cast(id as long) % 10 = 1").select("id")
    return labels.assemble(rows, there, labels.PUBLICATION_LABELS)


@query(CLASSIFIED + """SELECT pillar_curated, count(*) AS n FROM classified WHERE scope_curated = 'in' AND pillar_curated NOT IN ('PB', 'F') GROUP BY pillar_curated""")
def unrecognised_report(spark, d):
    return review.unrecognised(_classified(spark, d), ("PB", "F")).groupBy("pillar_curated").agg(F.count("*").alias("n"))


# --- names --------------------------------------------------------------------------------------


@query("""
WITH known AS (SELECT n_name AS name, r_name AS clean FROM nation JOIN region ON n_regionkey = r_regionkey)
SELECT c_custkey, upper(coalesce(k.clean, m.name)) AS clean FROM (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_name ELSE n_name END AS name FROM customer JOIN nation ON c_nationkey = n_nationkey) m LEFT JOIN known k USING (name)
""")
def name_map_upper(spark, d):
    nation, region = table(spark, d, "nation"), table(spark, d, "region")
    known = nation.join(region, nation.n_regionkey == region.r_regionkey).select(F.col("n_name").alias("name"), F.col("r_name").alias("clean"), F.col("n_nationkey").alias("ordinal"))
    c = table(spark, d, "customer")
    rows = c.join(nation, c.c_nationkey == nation.n_nationkey).select("c_custkey", F.when(c.c_custkey % 3 == 0, c.c_name).otherwise(nation.n_name).alias("raw"))
    return names.mapped(F.col("raw"), known, rows, "upper_name").select("c_custkey", F.col("upper_name").alias("clean"))


@query("""
WITH part_rows AS (SELECT string_split(p_name, ' ')[1] AS a, string_split(p_name, ' ')[-1] AS b, row_number() OVER (ORDER BY p_partkey) - 1 AS n FROM part),
all_rows AS (SELECT a AS company, 0 AS c, n FROM part_rows UNION ALL SELECT b, 1, n FROM part_rows)
SELECT company, CAST(min(c) AS INTEGER) AS first_column, CAST(arg_min(n, c * 1000000000000 + n) AS BIGINT) AS first_row FROM all_rows WHERE company IS NOT NULL GROUP BY company
""")
def company_list(spark, d):
    """The values of two columns in the order in which they are met; a Parquet file tells the rows' numbers."""
    part = table(spark, d, "part").select(F.split("p_name", " ").alias("words"), F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")).alias("position"))
    part = part.select(F.element_at("words", 1).alias("a"), F.element_at("words", -1).alias("b"), "position")
    return names.ordered_union((part, "a", "position"), (part, "b", "position")).select("company", F.col("ordinal.column").alias("first_column"), F.col("ordinal.position.row").alias("first_row"))


FUZZY_SQL = """
WITH raw AS (SELECT DISTINCT CASE p_partkey % 3 WHEN 0 THEN array_to_string(list_reverse(string_split(p_name, ' ')), ' ') WHEN 1 THEN p_name[1:len(p_name) - 1] ELSE upper(p_name) END AS name FROM part WHERE p_name IS NOT NULL),
n AS (SELECT name, trim(lower(name)) AS a FROM raw), c AS (SELECT p_name AS company, trim(lower(p_name)) AS b, min(p_partkey) AS ordinal FROM part GROUP BY ALL),
pairs AS (SELECT DISTINCT a, b, list_sort(string_split(a, ' ')) AS x, list_sort(string_split(b, ' ')) AS y FROM n, c),
sets AS (SELECT a, b, x, y, array_to_string(list_filter(list_distinct(x), lambda w: list_contains(y, w)).list_sort(), ' ') AS common,
  array_to_string(list_filter(list_distinct(x), lambda w: NOT list_contains(y, w)).list_sort(), ' ') AS only_a, array_to_string(list_filter(list_distinct(y), lambda w: NOT list_contains(x, w)).list_sort(), ' ') AS only_b FROM pairs),
texts AS (SELECT a, b, common, only_a, only_b, array_to_string(x, ' ') AS sa, array_to_string(y, ' ') AS sb, trim(common || ' ' || only_a) AS l, trim(common || ' ' || only_b) AS r FROM sets),
asked AS (SELECT a AS s, b AS t FROM texts UNION SELECT sa, sb FROM texts UNION SELECT l, r FROM texts UNION SELECT common, l FROM texts UNION SELECT common, r FROM texts),
equal AS (SELECT s, t, list_transform(string_split(s, ''), lambda p: list_transform(string_split(t, ''), lambda q: CAST(p = q AS INTEGER))) AS rows FROM asked WHERE s <> '' AND t <> ''),
-- a row of longest common subsequences is the running maximum of what the row before allows
lcs AS (SELECT s, t, list_max(list_reduce(list_prepend(list_transform(rows[1], lambda z: 0), rows), lambda o, e:
  list_transform(range(1, len(e) + 1), lambda j: list_max(list_transform(range(1, j + 1), lambda i: greatest(o[i], CASE WHEN i > 1 THEN o[i - 1] ELSE 0 END + e[i])))))) AS k FROM equal),
ratios AS (SELECT s, t, 200.0::DOUBLE * k / (len(s) + len(t)) AS v FROM lcs),
scores AS (SELECT a, b, greatest(p.v, CASE WHEN greatest(len(a), len(b)) < 1.5 * least(len(a), len(b)) THEN 0.95::DOUBLE * CASE WHEN common <> '' AND (only_a = '' OR only_b = '') THEN 100 ELSE greatest(q.v, u.v, coalesce(w.v, 0), coalesce(z.v, 0)) END ELSE 0 END) AS score
  FROM texts LEFT JOIN ratios p ON p.s = a AND p.t = b LEFT JOIN ratios q ON q.s = sa AND q.t = sb LEFT JOIN ratios u ON u.s = l AND u.t = r LEFT JOIN ratios w ON w.s = common AND w.t = l LEFT JOIN ratios z ON z.s = common AND z.t = r),
best AS (SELECT name, company, score FROM n JOIN scores USING (a) JOIN c USING (b) WHERE score >= 95 QUALIFY row_number() OVER (PARTITION BY name ORDER BY score DESC, ordinal) = 1)
SELECT name, CASE WHEN len(company) >= len(name) * 0.5 THEN company ELSE name END AS match, CASE WHEN len(company) >= len(name) * 0.5 THEN round(score, 4) END AS score FROM n LEFT JOIN best USING (name)
"""


@query(FUZZY_SQL)
def fuzzy_name_match(spark, d):
    """Part names with their words turned around or a letter lost, against the list of part names."""
    part = table(spark, d, "part").select("p_partkey", "p_name")
    i = F.col("p_partkey")
    changed = F.when(i % 3 == 0, F.array_join(F.reverse(F.split("p_name", " ")), " ")).when(i % 3 == 1, F.expr("substring(p_name, 1, length(p_name) - 1)")).otherwise(F.upper("p_name"))
    companies = part.groupBy(F.col("p_name").alias("company")).agg(F.min("p_partkey").alias("ordinal"))
    return names.nearest_company(part.select(changed.alias("name")), companies).select("name", "match", F.round("score", 4).alias("score"))


@query("""
SELECT doc_id FROM (SELECT d.doc_id, d.source, d.lang, d.n_chars, regexp_replace(d.text, '<[^>]*>', '', 'g') AS plain FROM documents d)
WHERE contains(lower(plain), 'the and') AND doc_id NOT IN (SELECT doc_id FROM labels)
QUALIFY row_number() OVER (PARTITION BY source ORDER BY (coalesce(plain <> '', false)) DESC, (coalesce(plain <> '', false) AND coalesce(lang IN ('en', 'de'), false)) DESC, n_chars DESC NULLS LAST, doc_id) = 1
""")
def curate_documents(spark, d):
    """The flagship: search, clean, leave out what is known, one representative of each source."""
    docs = table(spark, d, "documents").withColumn("plain", strip_markup("text"))
    new = curate.unseen(docs.where(search.matches('"the and"', "plain")), table(spark, d, "labels"), "doc_id")
    return curate.representatives(new, ["source"], ("plain",), "lang", ("en", "de"), "n_chars", "doc_id").select("doc_id")


from . import table_queries  # noqa: E402, F401  (registers its queries)
