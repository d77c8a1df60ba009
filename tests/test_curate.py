import random

from pyspark.sql import functions as F

from curatrix.functions.nulls import differs, null_safe_join
from curatrix.operators import curate

RECORD = "id string, family_id long, jurisdiction string, priority_year int, publication_year int, kind string, title string, abstract string"


def test_latest_version_drops_null_keys_unless_asked(spark):
    rows = [("a", 1, "US", 2000, 2005, "A1", None, None), ("b", 1, "US", 2000, 2005, "B2", None, None), ("c", None, "US", 2000, 2009, "A1", None, None), ("d", 1, "EP", 2000, None, "A1", None, None)]
    df = spark.createDataFrame(rows, RECORD)
    key = ["family_id", "jurisdiction", "priority_year"]
    assert {r.id for r in curate.latest_versions(df, key, ["publication_year", "kind"]).collect()} == {"b", "d"}
    assert {r.id for r in curate.latest_versions(df, key, ["publication_year", "kind"], keep_null_keys=True).collect()} == {"b", "c", "d"}


def test_representative_follows_the_rule(spark):
    rnd = random.Random(1)
    rows = [(str(i), rnd.choice([1, 2, 3, 4, 5, None]), rnd.choice(["WO", "EP", "US", "CN", None]), 2000, rnd.choice([1999, 2001, 2005, None]), "A", rnd.choice(["t", "", None]), rnd.choice(["x", "", None])) for i in range(80)]

    def best(family):
        full = [r for r in family if r[6] and r[7]]
        pool = [r for r in full if r[2] in ("WO", "EP", "US")] or full or family
        return min(pool, key=lambda r: (-(r[4] or 0), r[0]))[0]

    want = {best([r for r in rows if r[1] == f]) for f in range(1, 6)}
    df = spark.createDataFrame(rows, RECORD)
    assert {r.id for r in curate.representatives(df, ["family_id"]).collect()} == want
    assert {r.id for r in curate.representatives(df.repartition(7), ["family_id"]).collect()} == want


def test_supersession_uses_the_newest_stored_version(spark):
    s = "id string, k string, publication_year int"
    stored = spark.createDataFrame([("a", "x", 2000), ("b", "x", 2004), ("c", None, 2000), ("d", "z", 2001)], s)
    incoming = spark.createDataFrame([("e", "x", 2003), ("f", None, 2001), ("g", "new", 1990), ("h", "z", 2001)], s)
    stay, enter = curate.supersede(stored, incoming, ["k"])
    assert {r.id for r in stay.collect()} == {"a", "b", "d"}
    assert {r.id for r in enter.collect()} == {"f", "g"}


def test_null_semantics(spark):
    a = spark.createDataFrame([(1, None), (2, "x")], "id int, k string")
    b = spark.createDataFrame([(None, 10)], "k string, v int")
    assert {r.id for r in null_safe_join(a, b, ["k"]).collect()} == {1}
    assert {r.id for r in curate.unseen(a, b, "k").collect()} == {2}
    assert {r.id for r in a.where(differs("k", "x")).collect()} == {1}
    assert {(r.id, r.is_known) for r in curate.split_known(a, b, "k").collect()} == {(1, True), (2, False)}


def test_top_keys_breaks_ties_by_key(spark):
    df = spark.createDataFrame([(3, "a", 1), (1, "b", 1), (2, None, 9), (3, "a", 1), (4, "c", 1)], "id int, n string, count int")
    assert [(r.id, r.total) for r in curate.top_keys(df, ["id", "n"], "count", 2).collect()] == [(3, 2), (1, 1)]


def test_propagation_gives_one_decision_to_a_family(spark):
    members = spark.createDataFrame([("a", 1), ("b", 1), ("c", 2), ("d", None)], "id string, family_id long")
    decided = spark.createDataFrame([(1, "in", "z"), (1, "out", "y"), (None, "in", "q")], "family_id long, pred string, id string")
    got = {r.id: r.pred for r in curate.propagate(members, decided, "family_id", ["pred"], [F.asc("id")]).collect()}
    assert got == {"a": "out", "b": "out", "c": None, "d": None}
