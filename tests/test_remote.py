import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curatrix.sources import connectors, exchange, remote

from .doubles import Folder

SERVICE = "tests.doubles:folder_service"


@pytest.fixture
def folder(spark, tmp_path):
    """A folder for the doubles, which Python workers that start from now on know, too."""
    (tmp_path / "svc").mkdir()
    os.environ["FOLDER_SERVICE"] = str(tmp_path / "svc")
    env = spark.sparkContext.environment
    env["FOLDER_SERVICE"] = str(tmp_path / "svc")
    yield tmp_path / "svc"
    del env["FOLDER_SERVICE"], os.environ["FOLDER_SERVICE"]


def requests_of(spark, n):
    return spark.range(n).select(F.concat(F.lit("r"), "id").alias("custom_id"), F.to_json(F.struct(F.col("id").alias("n"))).alias("params"))


def test_requests_and_answers_travel_by_executors(spark, folder, tmp_path):
    client = exchange.ExecutorBatches(spark, SERVICE, f"file://{tmp_path}/x", chunk=3, tasks=4)
    batch = client.submit(requests_of(spark, 40))
    log = (folder / "log").read_text().split("\n")[:-1]
    assert str(os.getpid()) not in {x.split()[0] for x in log}  # not by the driver
    sent = [json.loads((folder / f"svc-{x.split()[1]}").read_text()) for x in log]
    assert all(len(s) <= 3 for s in sent) and sorted(r["custom_id"] for s in sent for r in s) == sorted(f"r{i}" for i in range(40))
    assert client.submit(requests_of(spark, 40)) == batch and len((folder / "log").read_text().split("\n")[:-1]) == len(log)
    assert client.state(batch) == "in_progress"
    assert 0 < client.results(spark, batch).count() < 40
    (folder / "ready").touch()
    assert client.state(batch) == "ended"
    assert {r.custom_id: json.loads(r.payload)["n"] for r in client.results(spark, batch).collect()} == {f"r{i}": i for i in range(40)}
    none = client.submit(requests_of(spark, 0))
    assert none != batch and client.results(spark, none).count() == 0 and client.state(none) == "ended"


def test_a_crash_between_submit_and_commit_submits_once(spark, folder, tmp_path):
    client = exchange.ExecutorBatches(spark, SERVICE, f"file://{tmp_path}/x", chunk=5, tasks=1)
    (folder / "die").touch()
    with pytest.raises(Exception, match="lost after the service took the chunk"):
        client.submit(requests_of(spark, 12))
    assert exchange._get(client.folder, "manifest-x") is None
    batch = client.submit(requests_of(spark, 12))
    names = [x.split()[1] for x in (folder / "log").read_text().split("\n")[:-1]]
    assert len(names) == len(set(names)) == 3
    (folder / "ready").touch()
    assert client.results(spark, batch).count() == 12
    # an intent of which the service knows nothing is sent
    exchange._put(client.folder, "intent-zz", "zz")
    assert Folder(str(folder)).find("zz") is None


def test_a_stream_goes_on_with_new_pages(spark, folder, tmp_path):
    client = exchange.ExecutorBatches(spark, SERVICE, f"file://{tmp_path}/x", chunk=7, tasks=2)
    batch = client.submit(requests_of(spark, 20))

    def drain():
        query = client.stream(spark, batch).writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/cp").option("path", f"{tmp_path}/out").trigger(availableNow=True).start()
        query.awaitTermination()
        return sorted(r.custom_id for r in spark.read.schema(exchange.RESULTS).parquet(f"{tmp_path}/out").collect())

    first = drain()
    assert 0 < len(first) < 20
    (folder / "ready").touch()
    second = drain()
    assert second == sorted(f"r{i}" for i in range(20)) and drain() == second


MEMBERS = T.StructType([T.StructField("id", T.StringType()), T.StructField("family_id", T.LongType()), T.StructField("publication_year", T.IntegerType())])
SEARCH = "tests.doubles:search_service"


def test_no_key_is_lost_at_the_limits(spark, folder):
    keys = spark.range(1300).unionByName(spark.range(20)).select(F.when(F.col("id") != 5, F.col("id")).alias("family_id"))
    got = remote.members_of(keys, SEARCH, MEMBERS, (2000, 2002), tasks=2).collect()
    assert sorted(r.id for r in got) == sorted(f"{k}-{m}" for k in range(1300) if k != 5 for m in range(3))
    asked = [tuple(map(int, x.split())) for x in (folder / "asked").read_text().split("\n")[:-1]]
    assert max(n for n, _ in asked) == 500 and max(skip for _, skip in asked) == 1000  # 1500 rows of 500 families come in pages
    assert {r.publication_year for r in remote.members_of(keys, SEARCH, MEMBERS, (2001, 2001)).collect()} == {2001}
    assert remote.members_of(keys.limit(0), SEARCH, MEMBERS, (2000, 2002)).count() == 0


def test_summaries_that_reach_the_limit_are_asked_for_in_halves(spark, folder):
    pubs = spark.range(600).select(F.col("id").cast("string").alias("id"))
    want = {}
    for k in range(600):
        for r in {k % 300, 7}:
            want[f"r{r}"] = want.get(f"r{r}", 0) + 1
    for limit in (1000, 50):
        got = remote.researchers_of(pubs, SEARCH, limit=limit, tasks=2).collect()
        assert {r.id: r["count"] for r in got} == want
    with pytest.raises(Exception, match="alone reaches the limit"):
        remote.researchers_of(pubs, SEARCH, limit=1).collect()


def test_publications_of_people_come_once(spark, folder):
    people = spark.range(450).select(F.concat(F.lit("r"), "id").alias("id"))
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("year", T.IntegerType())])
    got = [r.id for r in remote.publications_of(people, SEARCH, schema, (1990, 2020)).collect()]
    assert sorted(got) == sorted(f"p{j}" for j in range(451))
    assert remote.key_query("patents", "family_id", ['a"b', "c"], "patents", "year", (1, 2)) == 'search patents where family_id in ["a\\"b", "c"] and year in [1:2] return patents'


def test_years_are_pushed_to_the_service(spark, folder):
    spark.dataSource.register(connectors.PagedSearch)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        load = lambda: spark.read.format("paged_search").schema("id string, year int").option("client", "tests.doubles:year_service").option("query", "search x").option("year", "year").option("limit", 10).load()
        assert sorted(r.year for r in load().where("year >= 2001 and year < 2004 and id <> '2002'").collect()) == [2001, 2003]
        assert set((folder / "asked").read_text().split("\n")[:-1]) == {"search x where year in [2001:2003]"}
        assert load().where("year = 2005").count() == 1 and load().where("year > 2005 and year < 2005").count() == 0
        assert load().count() == 40
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")
