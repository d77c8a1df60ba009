import pytest
from pyspark.sql import functions as F

from curatrix.operators import classify as ml
from curatrix.plans import stages
from curatrix.plans.pipeline import Pipeline
from curatrix.sources.store import TableStore

from .doubles import FileBatches

SCHEMA = "id string, family_id long, jurisdiction string, priority_year int, publication_year int, kind string, title string, abstract string, cpc array<string>, assignee_names array<string>"


def corpus_rows():
    rows = []
    for i in range(40):
        milk = i % 2 == 0
        text = f"oat milk protein number {i}" if milk else f"steel beam number {i}"
        rows.append((f"US.{i}", i // 2 if i % 5 else None, "US" if i % 3 else "CN", 2000, 2005 + i % 4, "A1", text, f"<p>{text} about food</p>", ["A23C"] if i % 4 else None, ["Acme Inc", "Other co"] if i % 6 else None))
    return rows


def test_a_corpus_from_search_to_export(spark, tmp_path):
    store = TableStore(spark, f"file://{tmp_path}/db")
    c = stages.Corpus(store, f"file://{tmp_path}/models", queries=['"food" AND ("milk" OR "beam")'], codes=["A23C"], allowed_codes=["A23C"], max_fn=0.2)
    table = spark.createDataFrame(corpus_rows(), SCHEMA)
    training = spark.createDataFrame([(f"t{i}", f"oat milk {i}" if i % 2 else f"steel {i}", "x", "in" if i % 2 else "out", "PB" if i % 2 else None) for i in range(40)], "id string, title string, abstract string, scope string, pillar string")

    def answer(p):
        text = p["messages"][0]["content"]
        if p["tool_choice"]["name"] == "record_scope":
            return {"scope": "in" if "milk" in text else "out", "confidence": 6, "plant_based": True, "fermentation": False, "cultivated": False, "cross_cutting": False}
        return {"primary_category": "other" if "category" in p["tool_choice"]["name"] else {"label_endproduct": "Cheese", "label_ingredient": "Colours"}.get(p["tool_choice"]["name"], "BF")}

    client = FileBatches(f"file://{tmp_path}/batches", answer)
    known = spark.createDataFrame([("Acme Inc", "Acme", 0)], "name string, clean string, ordinal int")
    companies = spark.createDataFrame([("ACME", 0), ("Other Co", 1)], "company string, ordinal int")
    steps = [
        ("train", lambda r: stages.train(c, training)),
        ("acquire", lambda r: stages.acquire(c, table, r["run"])),
        ("classify", lambda r: stages.classify(c, r["run"])),
        ("scope", lambda r: stages.scope(c, r["run"], client, 0)),
        ("reverse", lambda r: stages.reverse_families(c, table, r["run"])),
        ("names", lambda r: stages.clean_names(c, known, companies)),
        ("review", lambda r: stages.review_rows(c, f"{tmp_path}/review")),
        ("label", lambda r: stages.label(c, client, 0)),
        ("export", lambda r: stages.export(c, f"{tmp_path}/out")),
    ]
    run = Pipeline(f"{tmp_path}/status", steps).run({})
    assert set(run["steps"].values()) == {"done"}
    rows = {r.id: r for r in store.read("classified").collect()}
    assert len(rows) == store.read("classified").count()
    assert all("<p>" not in r.abstract for r in rows.values())
    families = {}
    for r in rows.values():
        if r.family_id is not None:
            families.setdefault(r.family_id, set()).add((r.pred_combined, r.proba_scope))
    assert families and all(len(v) == 1 for v in families.values())
    named = {r.id: r.assignee_names_cleaned for r in rows.values()}
    assert all(v is None or v == ["ACME", "Other Co"] for v in named.values()) and any(named.values())
    labelled = store.read("labelled")
    assert labelled.count() > 0 and {r.research_category for r in labelled.collect()} == {"Other"} and {r.subpillar for r in labelled.collect()} == {"NA"}
    assert labelled.where(F.col("end_product") == "Cheese").count() == labelled.count()
    assert spark.read.csv(f"{tmp_path}/out", header=True).count() == labelled.count()
    before = store.read("classified").count()
    again = Pipeline(f"{tmp_path}/status", steps[1:4]).run({})  # a second run finds nothing new
    assert store.read(again["run"]).count() == 0 and store.read("classified").count() == before


def test_single_records_and_human_review(spark, tmp_path):
    store = TableStore(spark, f"file://{tmp_path}/db")
    c = stages.Corpus(store, f"file://{tmp_path}/models", families=False, queries=['"milk"'], kind="article", year="year")
    pubs = spark.createDataFrame([("p1", 2000, "article", "milk", "a", [("r", "A", "B")]), ("p2", 2001, "article", "beam", "b", [("r", "A", "B")]), ("p3", 2001, "book", "milk", "b", None)], "id string, year int, type string, title string, abstract string, researchers array<struct<id:string,first_name:string,last_name:string>>")
    stages.acquire(c, pubs, "run")
    assert {r.id for r in store.read("run").collect()} == {"p1"}
    store.replace("run", store.read("run").withColumn("pred_combined", F.lit(1)))
    stages.reverse_researchers(c, pubs, "run")
    assert {r.id for r in store.read("run_reverse").collect()} == {"p1", "p2"}
    store.replace("classified", spark.createDataFrame([("p1", "in", 4.0, "F", "PB", "in"), ("p2", "out", 1.0, "NA", "NA", "in")], "id string, scope_LLM string, confidence_LLM double, pillar_LLM string, pred_pillar string, pred_combined string"))
    stages.review_rows(c, f"{tmp_path}/review")
    assert spark.read.csv(f"{tmp_path}/review", header=True).count() == 1
    spark.createDataFrame([("p1", "in", "F", "240101", "me"), ("zz", "in", "F", "240101", "me")], "id string, scope_curated string, pillar_curated string, date_review string, reviewer string").write.csv(f"{tmp_path}/back", header=True)
    stages.merge_reviewed(c, f"{tmp_path}/back")
    assert {(r.id, r.scope_curated, r.reviewer) for r in store.read("classified").collect()} == {("p1", "in", "me"), ("p2", "out", "auto")}
    assert ml.hash_encoder()(["a b"]).shape == (1, 64)


@pytest.mark.parametrize("kernels", [True, False])
@pytest.mark.parametrize("share", [None, 0.25])
def test_training_with_a_test_set_or_folds(spark, tmp_path, kernels, share):
    c = stages.Corpus(TableStore(spark, f"file://{tmp_path}/db"), f"file://{tmp_path}/models", families=False, with_kernel=kernels, test_size=share, max_fn=0.2)
    training = spark.createDataFrame([(f"t{i}", f"oat milk {i}" if i % 2 else f"steel {i}", "x", "in" if i % 2 else "out", "PB" if i % 4 == 1 else "F") for i in range(80)], "id string, title string, abstract string, scope string, pillar string")
    threshold = stages.train(c, training)
    assert 0 < threshold <= 1
    rows = training.select("id", "title", "abstract").join(c.store.read("training_embeddings"), "id")
    out = {r.id: r for r in stages._predict(c, rows).collect()}
    assert len(out) == 80 and sum((r.pred_scope == 1) == (int(i[1:]) % 2 == 1) for i, r in out.items()) > 60
    assert {r.pred_pillar for r in out.values()} <= {"PB", "F"} and all(0 <= r.proba_pillar <= 1 for r in out.values())
    assert "embeddings" in rows.columns and "features" not in next(iter(out.values())).asDict()


def test_company_files(spark, tmp_path):
    (tmp_path / "list.csv").write_text("Name,Cleaned-up Name\nacme inc,Acme\nbeta ag,Beta\nacme inc,Acme Group\n")
    (tmp_path / "db.csv").write_text("Company\nZeta\nBeta\n\"Acme, Ltd\"\n")
    known, companies = stages.company_files(spark, f"file://{tmp_path}/list.csv", f"file://{tmp_path}/db.csv")
    assert [r.company for r in companies.orderBy("ordinal").collect()] == ["Acme", "Beta", "Acme Group", "Zeta", "Acme, Ltd"]
    from curatrix.operators import names

    df = spark.createDataFrame([("acme inc",), ("ACME GROUPS",)], "name string")
    assert [r.clean_name for r in names.mapped(F.col("raw"), known, df.withColumnRenamed("name", "raw"), "clean_name").collect()] == ["ACME GROUP", "ACME GROUPS"]
    found = {r.name: r.match for r in names.nearest_company(df, companies).collect()}
    assert found["ACME GROUPS"] == "Acme Group"
