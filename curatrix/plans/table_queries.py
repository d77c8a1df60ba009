"""Queries that go through the table store, files, connectors and group steps, with their SQL."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..functions.nulls import holds
from ..functions.schema import align, ordered_unique, suffixed
from ..functions.text import fold_accents, joined_text, stamp
from ..operators import classify, curate, kernel, labels, names, review, verdicts
from ..sources import connectors, files, scratch
from ..sources.store import TableStore
from ..streaming import ingest
from ..streaming.embeddings import embed_in_batches
from .queries import query, table


def _store(spark) -> TableStore:
    return TableStore(spark, scratch.folder(spark, "tables"))


# --- store --------------------------------------------------------------------------------------


@query("SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus END AS o_orderstatus FROM orders")
def store_append_once(spark, d):
    """A table is created and gets two appends, one with all columns and one with some; both are repeated and are there once."""
    store, orders = _store(spark), table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    store.create("orders", orders.where("o_orderkey % 3 = 1"))
    for _ in range(2):
        store.append("orders", orders.where("o_orderkey % 3 = 2"), "all columns")
        store.append("orders", orders.where("o_orderkey % 3 = 0").select("o_custkey", "o_orderkey"), "some columns")
    return store.read("orders")


@query("""
SELECT c_custkey, CASE WHEN c_nationkey = 3 THEN 'moved' ELSE c_mktsegment END AS c_mktsegment, CASE WHEN c_nationkey = 3 THEN '240101' END AS "date_ML"
FROM customer WHERE c_acctbal >= 0 OR c_acctbal IS NULL
""")
def store_evolution(spark, d):
    """Create if absent, add a column, update by key, delete by key: each a version of its own."""
    store, customers = _store(spark), table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    store.create_if_absent("customers", customers)
    store.create_if_absent("customers", customers.limit(1))
    store.add_columns("customers", {"date_ML": "string", "c_mktsegment": "string"})
    moved = customers.where("c_nationkey = 3").select("c_custkey", F.lit("moved").alias("c_mktsegment"), F.lit("240101").alias("date_ML"))
    store.update("customers", moved, "c_custkey", ["c_mktsegment", "date_ML"])
    store.delete("customers", customers.where("c_acctbal < 0"), "c_custkey")
    return store.read("customers").select("c_custkey", "c_mktsegment", "date_ML")


@query("""
SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN '950101' WHEN n > 0 THEN day END AS day FROM customer LEFT JOIN
 (SELECT o_custkey, strftime(min(o_orderdate), '%y%m%d') AS day, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey
""")
def store_replace_when_new(spark, d):
    """A table is replaced by itself with a column filled from another."""
    store = _store(spark)
    store.replace("t", table(spark, d, "customer").select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, "950101").alias("day")))
    first = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("k")).agg(stamp(F.min("o_orderdate")).alias("first"))
    rows = store.read("t").join(first, F.col("c_custkey") == F.col("k"), "left")
    store.replace("t", rows.select("c_custkey", F.coalesce("day", "first").alias("day")))
    return store.read("t")


@query("SELECT 'customers' AS name, (SELECT count(*) FROM customer) AS n UNION ALL SELECT 'suppliers', (SELECT count(*) FROM supplier)")
def catalog_probe(spark, d):
    """Which tables there are, and how large; one that does not exist is not listed."""
    store = _store(spark)
    for name, source in (("customers", "customer"), ("suppliers", "supplier")):
        store.create_if_absent(name, table(spark, d, source))
    out = None
    for name in store.tables():
        part = store.read(name).agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        out = part if out is None else out.unionByName(part)
    return out


@query("""SELECT "column_name" AS name FROM (DESCRIBE orders) UNION ALL SELECT 'date_ML'""")
def schema_only_scan(spark, d):
    """The columns of a table, as its files' footers tell them, with those that a later step adds, each once."""
    store = _store(spark)
    store.create("orders", table(spark, d, "orders"))
    found = ordered_unique(store.columns("orders"), ["o_orderkey", "date_ML"])
    return spark.createDataFrame([(c,) for c in found], "name string")


@query("""SELECT c_custkey, c_name AS "c_name_LLM", c_mktsegment AS "c_mktsegment_LLM" FROM customer""")
def rename_suffix(spark, d):
    return suffixed(table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment"), "_LLM", keep=("c_custkey",))


@query("SELECT CAST(o_custkey AS BIGINT) AS family_id, o_orderkey AS id, CAST(NULL AS VARCHAR) AS title FROM orders")
def cast_float_key(spark, d):
    """A key that a data frame has made a floating-point number becomes whole again; a missing column is null."""
    target = spark.createDataFrame([], "family_id long, id long, title string").schema
    return align(table(spark, d, "orders").select(F.col("o_custkey").cast("double").alias("family_id"), F.col("o_orderkey").alias("id")), target)


@query("SELECT doc_id, CAST(CASE WHEN toxic = 1 THEN 1 ELSE 0 END AS DOUBLE) AS label FROM documents LEFT JOIN labels USING (doc_id)")
def binary_label(spark, d):
    docs = table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels"), "doc_id", "left")
    return docs.select("doc_id", holds(F.col("toxic") == 1).cast("double").alias("label"))


# --- files --------------------------------------------------------------------------------------


@query("SELECT c_custkey AS id, c_name || ', \"' || c_mktsegment || '\"' || chr(10) || 'x' AS name, CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal END AS amount FROM customer")
def csv_round_trip(spark, d):
    """Quotes, commas, line ends and nulls come back from CSV as they went."""
    name = F.concat("c_name", F.lit(', "'), "c_mktsegment", F.lit('"\nx'))
    rows = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), name.alias("name"), F.when(F.col("c_custkey") % 5 != 0, F.col("c_acctbal")).alias("amount"))
    path = scratch.folder(spark, "csv")
    files.write_csv(rows, path)
    return files.read_csv(spark, path, "id long, name string, amount double")


@query("SELECT trim(p_name) AS value FROM part WHERE p_partkey % 4 <> 0")
def line_source(spark, d):
    """Lines with something on them, trimmed."""
    path = scratch.folder(spark, "lines")
    line = F.when(F.col("p_partkey") % 4 == 0, F.lit("   ")).otherwise(F.concat(F.lit("  "), "p_name", F.lit(" ")))
    table(spark, d, "part").select(line.alias("value")).write.text(path)
    return files.lines(spark, path)


@query("SELECT CASE WHEN p_partkey % 4 = 0 THEN '' ELSE ' ' || p_brand || ' ' END AS value FROM part")
def code_lines(spark, d):
    """Code lists are read as they are: blanks and empty lines stay."""
    path = scratch.folder(spark, "codes")
    table(spark, d, "part").select(F.when(F.col("p_partkey") % 4 == 0, F.lit("")).otherwise(F.concat(F.lit(" "), "p_brand", F.lit(" "))).alias("value")).write.text(path)
    return files.codes(spark, path)


@query("SELECT p_partkey FROM part WHERE p_brand IN (SELECT DISTINCT p_brand FROM part WHERE p_size > 45)")
def codes_from_file(spark, d):
    """Rows with a code of a list that is read from a file, as a join: the list may be of any length."""
    part, path = table(spark, d, "part"), scratch.folder(spark, "codes")
    part.where("p_size > 45").select("p_brand").distinct().write.text(path)
    return part.join(files.codes(spark, path).withColumnRenamed("value", "p_brand"), "p_brand", "left_semi").select("p_partkey")


# --- searches by people -------------------------------------------------------------------------


def _publications(spark, d):
    """Orders as publications, the suppliers of their lines as researchers, each once."""
    people = table(spark, d, "lineitem").select("l_orderkey", (F.col("l_partkey") % 97).cast("string").alias("p")).distinct()
    who = F.struct(F.concat(F.lit("r"), "p").alias("id"), F.when(F.col("p") != "13", F.concat(F.lit("first "), "p")).alias("first_name"), F.concat(F.lit("last "), "p").alias("last_name"))
    lists = people.groupBy("l_orderkey").agg(F.collect_list(who).alias("researchers"))  # the lines of an order
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.year("o_orderdate").alias("year"), "o_orderpriority")
    return orders.join(lists, F.col("id") == F.col("l_orderkey"), "left").drop("l_orderkey")


PEOPLE = """
WITH pairs AS (SELECT DISTINCT l_orderkey AS id, l_partkey % 97 AS p FROM lineitem),
urgent AS (SELECT o_orderkey AS id FROM orders WHERE o_orderpriority = '1-URGENT'),
people AS (SELECT 'r' || p AS r, 'first ' || p AS f, 'last ' || p AS l, count(*) AS n FROM pairs JOIN urgent USING (id) WHERE p <> 13 GROUP BY p)
"""


@query(PEOPLE + 'SELECT r AS id, f AS first_name, l AS last_name, n AS "count" FROM people')
def researchers_by_publications(spark, d):
    publications = _publications(spark, d)
    return connectors.researcher_counts(publications, publications.where("o_orderpriority = '1-URGENT'").select("id"))


@query(PEOPLE + """, top AS (SELECT r FROM people ORDER BY n DESC, r, f, l LIMIT 20)
SELECT o_orderkey AS id, year(o_orderdate) AS year FROM orders WHERE year(o_orderdate) BETWEEN 1993 AND 1996 AND o_orderkey IN (SELECT id FROM pairs JOIN top ON 'r' || p = r)""")
def publications_by_researchers(spark, d):
    """Publications, in a span of years, of the twenty people with most of the urgent ones."""
    publications = _publications(spark, d)
    counts = connectors.researcher_counts(publications, publications.where("o_orderpriority = '1-URGENT'").select("id"))
    people = curate.top_keys(counts, ["id", "first_name", "last_name"], "count", 20)
    return connectors.by_researchers(publications, people, "year", 1993, 1996).select("id", "year")


# --- verdicts, labels and reviews for whole groups ----------------------------------------------


@query("""
WITH reps AS (SELECT * FROM documents d JOIN labels USING (doc_id) WHERE source IS NOT NULL QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) = 1)
SELECT CAST(d.doc_id AS VARCHAR) AS id, CASE WHEN r.toxic = 1 THEN 'out' WHEN r.doc_id IS NOT NULL THEN 'in' WHEN d.doc_id % 2 = 0 THEN 'old' END AS "scope_LLM"
FROM documents d LEFT JOIN (SELECT * FROM reps WHERE doc_id % 3 <> 0) r USING (source)
""")
def verdict_to_family(spark, d):
    """Verdicts on one row of each group for all its members; groups without one keep what they had."""
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("n"), F.col("doc_id").cast("string").alias("id"), F.col("source").alias("family_id"))
    marked = docs.join(table(spark, d, "labels"), F.col("n") == F.col("doc_id")).where("family_id is not null")
    reps = curate.first_of_each(marked, ["family_id"], [F.asc("n")])
    answers = reps.where("n % 3 <> 0").select("id", F.when(F.col("toxic") == 1, "out").otherwise("in").alias("scope_LLM"))
    members = docs.withColumn("scope_LLM", F.when(F.col("n") % 2 == 0, "old"))
    return verdicts.to_family(members, answers, reps, ["scope_LLM"]).select("id", "scope_LLM")


@query("""
WITH rows AS (SELECT doc_id, coalesce(CASE WHEN doc_id % 3 <> 0 THEN source END, CAST(doc_id AS VARCHAR)) AS g, ['PB', 'F', 'CM', 'CC'][CAST(doc_id % 4 + 1 AS INTEGER)] AS p FROM documents),
answers AS (SELECT g, p, min(doc_id) AS first FROM rows GROUP BY ALL)
SELECT CAST(doc_id AS VARCHAR) AS id, p AS pillar_curated, 'label of ' || first AS primary_category FROM rows JOIN answers USING (g, p) WHERE first % 5 <> 0
""")
def label_spread(spark, d):
    """Labels of one row of each group and pillar for all rows of both."""
    i = F.col("doc_id")
    pillar = F.element_at(F.array(*[F.lit(p) for p in ("PB", "F", "CM", "CC")]), (i % 4 + 1).cast("int"))
    rows = table(spark, d, "documents").select(i, i.cast("string").alias("id"), F.when(i % 3 != 0, F.col("source")).alias("family_id"), pillar.alias("pillar_curated"))
    reps = curate.first_of_each(rows.withColumn("group_key", curate.group_key()), ["group_key", "pillar_curated"], [F.asc("doc_id")])
    answers = reps.where("doc_id % 5 <> 0").withColumn("primary_category", F.concat(F.lit("label of "), "id"))
    return labels.spread(rows, answers, ["primary_category"]).select("id", "pillar_curated", "primary_category")


DECIDED = "WITH rows AS (SELECT doc_id AS id, CASE doc_id % 4 WHEN 0 THEN 'manual_review' WHEN 1 THEN 'in' WHEN 2 THEN 'out' END AS scope_curated FROM documents)"


@query(DECIDED + " SELECT id, scope_curated, scope_curated = 'manual_review' AS by_people FROM rows WHERE scope_curated IS NOT NULL")
def review_split(spark, d):
    """What people have to decide, and what the rules have decided."""
    i = F.col("doc_id")
    rows = table(spark, d, "documents").select(i.alias("id"), F.when(i % 4 == 0, review.MANUAL).when(i % 4 == 1, "in").when(i % 4 == 2, "out").alias("scope_curated"))
    manual, rest = review.split_for_review(rows)
    return manual.withColumn("by_people", F.lit(True)).unionByName(rest.withColumn("by_people", F.lit(False)))


@query(DECIDED + " SELECT id, CASE WHEN id % 8 = 0 THEN 'out' ELSE scope_curated END AS scope_curated, CASE WHEN id % 8 = 0 THEN 'second' END AS reviewer FROM rows")
def review_merge(spark, d):
    """People's decisions come back by id; of two on one row the later counts, and unknown ids are ignored."""
    store, i = _store(spark), F.col("doc_id")
    store.create("classified", table(spark, d, "documents").select(i.alias("id"), F.when(i % 4 == 0, review.MANUAL).when(i % 4 == 1, "in").when(i % 4 == 2, "out").alias("scope_curated")))
    back, path = table(spark, d, "documents").where("doc_id % 8 = 0").select(i.alias("id")), scratch.folder(spark, "reviewed")
    first = back.select("id", F.lit("in").alias("scope_curated"), F.lit("first").alias("reviewer"), F.lit("240101").alias("date_review"))
    second = back.select("id", F.lit("out").alias("scope_curated"), F.lit("second").alias("reviewer"), F.lit("240202").alias("date_review"))
    unknown = back.select((-F.col("id") - 1).alias("id"), F.lit("in").alias("scope_curated"), F.lit("x").alias("reviewer"), F.lit("250101").alias("date_review"))
    files.write_csv(first.unionByName(second).unionByName(unknown), path)
    reviewed = files.read_csv(spark, path, "id long, scope_curated string, reviewer string, date_review string")
    store.update("classified", curate.first_of_each(reviewed, ["id"], [F.desc_nulls_last("date_review")]), "id", ["scope_curated", "reviewer"])
    return store.read("classified")


@query("""
SELECT doc_id, CASE WHEN quality IS NOT NULL THEN 'stored' ELSE 'new' END AS origin, CAST(coalesce(quality, n_chars % 2) AS INTEGER) AS pred FROM documents LEFT JOIN labels USING (doc_id)
""")
def resume_predictions(spark, d):
    """Predictions that a run has made before it failed are kept, only the other rows are predicted."""
    docs = table(spark, d, "documents").select("doc_id", "n_chars")
    stored = table(spark, d, "labels").where("quality is not null").select("doc_id", F.lit("stored").alias("origin"), F.col("quality").alias("pred"))
    fresh = curate.unseen(docs, stored, "doc_id").select("doc_id", F.lit("new").alias("origin"), (F.col("n_chars") % 2).cast("int").alias("pred"))
    return docs.select("doc_id").join(stored, "doc_id").unionByName(fresh)


# --- names --------------------------------------------------------------------------------------


@query("SELECT doc_id, regexp_replace(strip_accents(text), '[^\\x00-\\x7F]', '', 'g') AS plain FROM documents")
def accent_fold(spark, d):
    return table(spark, d, "documents").select("doc_id", fold_accents("text").alias("plain"))


@query("""
WITH known AS (SELECT n_name AS name, r_name AS clean FROM nation JOIN region ON n_regionkey = r_regionkey),
members AS (SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 7 = 1 THEN [] ELSE [n_name, c_mktsegment, n_name] END AS l FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT c_custkey, CASE WHEN l IS NULL THEN NULL WHEN len(l) = 0 THEN '' ELSE upper(coalesce(k.clean, l[1])) || '|' || upper(l[2]) || '|' || upper(coalesce(k.clean, l[3])) END AS clean
FROM members LEFT JOIN known k ON k.name = l[1]
""")
def name_map_lists(spark, d):
    """Lists of names by the map of variants: order is kept, null and empty lists stay what they are."""
    nation, region = table(spark, d, "nation"), table(spark, d, "region")
    known = nation.join(region, nation.n_regionkey == region.r_regionkey).select(F.col("n_name").alias("name"), F.col("r_name").alias("clean"), F.col("n_nationkey").alias("ordinal"))
    c = table(spark, d, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    listed = F.when(F.col("c_custkey") % 7 == 0, None).when(F.col("c_custkey") % 7 == 1, F.array().cast("array<string>")).otherwise(F.array("n_name", "c_mktsegment", "n_name"))
    rows = c.select(F.col("c_custkey").alias("id"), listed.alias("names"))
    return names.map_lists(rows, "names", known, "clean").select(F.col("id").alias("c_custkey"), F.array_join("clean", "|").alias("clean"))


# --- inference ----------------------------------------------------------------------------------

CENTRES = [[((3 * k + 5 * i) % 7 - 3) / 20 for i in range(64)] for k in range(3)]
MACHINES = [[1.0, -0.5, 0.25, -0.1], [-1.0, 1.5, 0.0, -0.3], [0.2, 0.3, -1.0, 0.5]]
KERNEL = "exp(-0.5 * list_sum(list_transform(list_zip(v, {c}::DOUBLE[]), lambda z: (z[1] - z[2]) * (z[1] - z[2]))))"


@query(f"""
WITH k AS (SELECT vec_id, {", ".join(KERNEL.format(c=c) + f" AS k{i}" for i, c in enumerate(CENTRES))} FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)),
m AS (SELECT vec_id, {", ".join(f"greatest(0, least(1, ({a} * k0 + {b} * k1 + {c} * k2 + {e} + 1) / 2)) AS p{i}" for i, (a, b, c, e) in enumerate(MACHINES))} FROM k),
p AS (SELECT vec_id, {", ".join(f"CASE WHEN p0 + p1 + p2 > 0 THEN p{i} / (p0 + p1 + p2) ELSE 1.0 / 3 END AS p{i}" for i in range(3))} FROM m)
SELECT vec_id, round(greatest(p0, p1, p2), 6) AS proba_pillar, CASE WHEN p0 >= p1 AND p0 >= p2 THEN 'CM' WHEN p1 >= p2 THEN 'F' ELSE 'PB' END AS pred_pillar FROM p
""")
def kernel_inference(spark, d):
    """Calibrated kernel machines with given weights: probabilities of three classes and the largest."""
    knots = [(np.array([-1.0, 1.0]), np.array([0.0, 1.0]))] * 3
    model = kernel.CalibratedMachines(["CM", "F", "PB"], kernel.Map(np.array(CENTRES), np.eye(3), 0.5), {kernel.NONE_OUT: np.array(MACHINES)[None]}, {kernel.NONE_OUT: [knots]})
    out = model.best(table(spark, d, "embeddings").select("vec_id", "embedding"), "embedding", "proba_pillar", "pred_pillar")
    return out.select("vec_id", F.round("proba_pillar", 6).alias("proba_pillar"), "pred_pillar")


@query("SELECT CAST(doc_id AS VARCHAR) AS id, CAST(64 AS INTEGER) AS dimensions FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def embed_batches(spark, d):
    """Embeddings of what has none, a commit after each batch; the same call again finds nothing to do."""
    store, work = _store(spark), scratch.folder(spark, "work")
    docs = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("id"), "source", "text")
    there = table(spark, d, "labels").select(F.col("doc_id").cast("string").alias("id"), F.array().cast("array<float>").alias("embeddings"))
    store.create("embeddings", there)
    for _ in range(2):
        embed_in_batches(store, "embeddings", docs, joined_text("source", "text"), classify.hash_encoder, work, 50_000)
    return store.read("embeddings").where("size(embeddings) > 0").select("id", F.size("embeddings").alias("dimensions"))


@query("""
SELECT o_custkey, o_orderkey AS id, o_orderdate FROM orders WHERE o_custkey IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey % 2, o_orderkey) = 1
""")
def ingest_latest(spark, d):
    """The latest order of each customer: even orders are there, odd ones arrive as a stream; of one day's the stored one stays."""
    store, work = _store(spark), scratch.folder(spark, "work")
    orders = table(spark, d, "orders")
    narrow = lambda df: df.select("o_custkey", F.col("o_orderkey").alias("id"), "o_orderdate")
    store.create("orders", narrow(orders.where("o_orderkey % 2 = 0")))
    stream = spark.readStream.schema(orders.schema).parquet(f"{d}/orders.parquet*")  # a pattern, as it may be one file
    odd = lambda df: narrow(df.where("o_orderkey % 2 = 1"))
    ingest.ingest(stream, store, "orders", ["o_custkey"], ["o_orderdate"], f"{work}/progress", odd).awaitTermination()
    return ingest.current(store.read("orders"), ["o_custkey"], ["o_orderdate"]).drop(ingest.ARRIVAL)
