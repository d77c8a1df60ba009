import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from curatrix.operators import classify, verdicts
from curatrix.plans.pipeline import Pipeline, incomplete, submitted
from curatrix.plans.queries import QUERIES, SQL
from curatrix.sources import connectors, files

from .doubles import FileBatches


def test_pipeline_resumes_where_it_failed(tmp_path):
    done, broken = [], [True]

    def second(run):
        if broken[0]:
            raise RuntimeError
        done.append("b")

    p = Pipeline(str(tmp_path), [("a", lambda run: done.append("a")), ("b", second)])
    with pytest.raises(RuntimeError):
        p.run({"x": 1})
    assert incomplete(str(tmp_path))["steps"] == {"a": "done", "b": "pending"}
    broken[0] = False
    assert p.run({"x": 2})["config"] == {"x": 1} and done == ["a", "b"]
    assert incomplete(str(tmp_path)) is None


def test_batches_and_requests(spark, tmp_path):
    df = spark.createDataFrame([("a_1.x", "T", None)], "id string, title string, abstract string")
    reqs = verdicts.requests(df, "tool", "m", 512, "prompt")
    client = FileBatches(f"file://{tmp_path}", lambda p: {"scope": "in", "n": p["max_tokens"], "m": p["messages"][0]["content"]})
    batch = client.submit(reqs)
    connectors.wait(client, batch, 0)
    r = client.results(spark, batch).first()
    assert r.custom_id == "a_1.x" and '"n": 512' in r.payload and "Title: T" in r.payload and client.submit(reqs) == batch


def fetch():
    rows = [{"id": str(i), "q": "x"} for i in range(5)]
    return lambda query, skip, limit: rows[skip : skip + limit]


def test_search_connectors(spark):
    spark.dataSource.register(connectors.PagedSearch)
    got = spark.read.format("paged_search").schema("id string, q string").option("client", "tests.test_plans:fetch").option("pages", 3).option("limit", 2).load()
    assert {r.id for r in got.collect()} == {"0", "1", "2", "3", "4"}
    pubs = spark.createDataFrame([("p1", 2000, [("r1", "A", "B"), ("r2", "C", None)]), ("p2", 2001, [("r1", "A", "B")]), ("p3", 2002, None)], "id string, year int, researchers array<struct<id:string,first_name:string,last_name:string>>")
    counts = connectors.researcher_counts(pubs, spark.createDataFrame([("p1",), ("p2",)], "id string"))
    assert [tuple(r) for r in counts.collect()] == [("r1", "A", "B", 2)]
    assert {r.id for r in connectors.by_researchers(pubs, counts, "year", 2000, 2005).collect()} == {"p1", "p2"}
    assert connectors.union_results(pubs.where("id='p1'"), pubs).count() == 3


def test_files(spark, tmp_path):
    (tmp_path / "q.txt").write_text(' "a" \n\n"b"\n')
    assert files.query_lines(str(tmp_path / "q.txt")) == ['"a"', '"b"']
    assert {r.value for r in files.lines(spark, str(tmp_path / "q.txt")).collect()} == {'"a"', '"b"'}
    df = spark.createDataFrame([("x, \"y\"\nz", 1)], "a string, n int")
    files.write_csv(df, str(tmp_path / "c"), True)
    assert [tuple(r) for r in files.read_csv(spark, str(tmp_path / "c"), "a string, n int").collect()] == [("x, \"y\"\nz", 1)]
    files.save_threshold(spark, str(tmp_path / "t"), 0.25)
    assert files.load_threshold(spark, str(tmp_path / "t")) == 0.25


def test_every_query_has_sql_or_a_reason():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) - set(SQL) == {"embed_classify_lr", "embed_classify_svm", "embed_cross_validated", "pillar_svm", "classify_pillar", "embed_new_documents"}


def test_classifiers_learn(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select(F.col("vec_id").alias("id"), F.col("embedding").alias("embeddings"), (F.col("label") == 0).cast("double").alias("label"))
    cv = classify.cross_validated(classify.features(rows), lambda t: classify.logistic(t, 0.1))
    assert cv.count() == rows.count()


def test_stamp(spark):
    from curatrix.functions.text import stamp

    assert spark.range(1).select(stamp(F.lit(datetime(2024, 5, 6)))).first()[0] == "240506"


def test_requests_carry_their_tool(spark):
    df = spark.createDataFrame([("a", "T", None, "p"), ("b", None, "B", "q")], "id string, title string, abstract string, pillar string")
    tools = {p: verdicts.label_tool("label_x", "Record it.", [p, "Other"]) for p in ("p", "q")}
    text = F.try_element_at(F.create_map(*[F.lit(x) for p, t in tools.items() for x in (p, json.dumps(t))]), F.col("pillar"))
    got = {r.custom_id: json.loads(r.params) for r in verdicts.requests(df, tools["p"], "m", 150, "prompt", tool_text=text).collect()}
    assert got["a"]["tools"] == [tools["p"]] and got["b"]["tools"] == [tools["q"]] and got["a"]["tool_choice"]["name"] == "label_x"
    assert "tools" not in json.loads(verdicts.requests(df, "named", "m", 1, "").first().params)


def test_a_batch_is_submitted_once(spark, tmp_path):
    class Client:
        sent = 0

        def submit(self, requests):
            Client.sent += 1
            return f"batch-{Client.sent}"

        def state(self, batch):
            return "ended"

    first, _ = submitted(str(tmp_path), "scope-r", Client(), None, 0)  # a crash before its answers are stored
    again, completed = submitted(str(tmp_path), "scope-r", Client(), None, 0)
    assert first == again == "batch-1" and Client.sent == 1
    completed()
    other, _ = submitted(str(tmp_path), "scope-r", Client(), None, 0)
    assert other == "batch-2"


def test_a_crash_between_intent_and_id_pays_once(tmp_path):
    class Service:
        sent = {}

        def find(self, key):
            return self.sent.get(key)

        def submit(self, requests, key):
            self.sent[key] = f"batch-{len(self.sent) + 1}"
            if len(self.sent) == 1:
                raise RuntimeError("lost after the service took it")
            return self.sent[key]

        def state(self, batch):
            return "ended"

    with pytest.raises(RuntimeError):
        submitted(f"file://{tmp_path}/b", "scope-r", Service(), None, 0)
    assert submitted(f"file://{tmp_path}/b", "scope-r", Service(), None, 0)[0] == "batch-1" and len(Service.sent) == 1
    assert submitted(f"file://{tmp_path}/b", "label-x", Service(), None, 0)[0] == "batch-2"


def test_prompts_are_given_read_or_the_default(tmp_path):
    from curatrix.plans import prompts
    from curatrix.plans.stages import Corpus

    (tmp_path / "category.txt").write_text(" from a file \n")
    c = Corpus(None, "", prompts={"scope": "given"}, prompt_folder=str(tmp_path))
    assert c.prompt("scope") == "given" and c.prompt("category") == c.prompt("category.PB") == "from a file"
    assert c.prompt("endproduct") == prompts.default("endproduct") and "schema" not in prompts.SCOPE
    with pytest.raises(ValueError, match="no prompt"):
        c.prompt("other")
    with pytest.raises(FileNotFoundError):
        files.prompt(str(tmp_path / "none.txt"))


def test_paged_search_reads_to_the_end(spark):
    spark.dataSource.register(connectors.PagedSearch)
    for pages in (None, 1, 2, 9):
        reader = spark.read.format("paged_search").schema("id string, q string").option("client", "tests.test_plans:fetch").option("limit", 2)
        found = (reader.option("pages", pages) if pages else reader).load()
        assert sorted(r.id for r in found.collect()) == ["0", "1", "2", "3", "4"]
