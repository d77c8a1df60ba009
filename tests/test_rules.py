import itertools

from pyspark.sql import functions as F

from curatrix.operators import classify, labels, review, verdicts


def test_pillar_truth_table(spark):
    values = (True, False, None)
    rows = [(i, *f) for i, f in enumerate(itertools.product(values, repeat=4))]
    df = spark.createDataFrame(rows, "i int, p boolean, f boolean, c boolean, x boolean").select("i", verdicts.pillar_of("p", "f", "c", "x").alias("v"))
    got = {r.i: r.v for r in df.collect()}
    for i, p, f, c, x in rows:
        n = sum(map(bool, (p, f, c)))
        assert got[i] == ("CC" if n > 1 or (x and not n) else "PB" if p else "F" if f else "CM" if c else "NA")


def _cases():
    return list(itertools.product(("in", "out", "NA", None), (None, 1.0, 2.0, 4.0, 5.0), (None, 0.5, 0.7, 0.9), ("PB", "NA", None), ("F", "PB", "NA", None), ("in", "out", None)))


def test_review_tables(spark):
    cases = _cases()
    schema = "i int, scope_LLM string, confidence_LLM double, proba_scope double, pred_pillar string, pillar_LLM string, pred_combined string"
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], schema).cache()
    less = lambda a, b: a is not None and a < b
    more = lambda a, b: a is not None and a > b
    patents = {r.i: (r.scope_curated, r.pillar_curated) for r in review.review_patents(df).collect()}
    publications = {r.i: (r.scope_curated, r.pillar_curated) for r in review.review_publications(df).collect()}
    for i, (scope, sure, p, pillar, llm, combined) in enumerate(cases):
        if combined == "out":
            want = "out"
        elif scope == "NA" and combined == "in":
            want = review.MANUAL
        elif scope == "in" and sure is not None and sure >= 5:
            want = "in"
        elif sure is not None and sure <= 4 and more(p, 0.8) and pillar != "NA":
            want = "in"
        elif scope == "out" and ((sure == 2 and less(p, 0.6) and pillar == "NA") or (sure == 1 and less(p, 0.8))):
            want = "out"
        else:
            want = review.MANUAL
        known = next((v for v in (llm, pillar) if v and v != "NA"), None)
        assert patents[i] == (want, None if want == "out" else known)
        inherit = (scope == "in" and more(sure, 4) and llm != "NA") or (scope == "in" and sure == 4 and llm != "NA" and llm is not None and llm == pillar) or (scope == "out" and less(sure, 2) and llm == "NA")
        assert publications[i] == (("out", None) if combined == "out" else (scope, llm) if inherit else (review.MANUAL, review.MANUAL))
    manual, rest = review.split_for_review(review.review_patents(df))
    assert manual.count() + rest.count() == len(cases)


def test_verdict_parsing(spark):
    rows = [
        ("a_1", "succeeded", "tool_use", '{"primary_category": " MEAT ", "secondary_category": "cheese"}'),
        ("b", "succeeded", "end", "{broken"),
        ("c", "errored", None, None),
        ("d", "succeeded", "tool_use", '{"primary_category": "nothing"}'),
        ("e", "succeeded", "tool_use", '{"primary_category": "Meat", "secondary_category": "nothing"}'),
        ("f", "succeeded", None, None),
    ]
    df = spark.createDataFrame(rows, "custom_id string, result_type string, stop_reason string, payload string")
    got = {r.id: (r.primary_x_LLM, r.secondary_x_LLM, r.x_status_LLM) for r in verdicts.parse_labels(df, labels.END_PRODUCTS, "x").collect()}
    assert got == {"a_1": ("Meat", "Cheese", "ok"), "b": (None, None, "parse_error"), "c": (None, None, "errored"), "d": (None, None, "parse_error"), "e": ("Meat", None, "ok"), "f": (None, None, "parse_error")}
    scope = spark.createDataFrame([("a", "succeeded", "tool_use", '{"scope":"in","confidence":6,"plant_based":"false","fermentation":true,"cultivated":false,"cross_cutting":"no"}'), ("b", "succeeded", None, "x")], df.schema)
    r = {x.id: x for x in verdicts.parse_scope(scope).collect()}
    assert (r["a"].pillar_LLM, r["a"].plant_based_LLM, r["a"].confidence_LLM) == ("F", False, 6.0)
    assert (r["b"].pillar_LLM, r["b"].status_LLM) == (None, "parse_error")


def test_family_keeps_old_verdicts_without_a_new_one(spark):
    members = spark.createDataFrame([("a", 1, "in"), ("b", 1, None), ("c", 2, "out"), ("d", None, "in")], "id string, family_id long, scope_LLM string")
    new = spark.createDataFrame([("b", "out")], "id string, scope_LLM string")
    got = {r.id: r.scope_LLM for r in verdicts.to_family(members, new, members, ["scope_LLM"]).collect()}
    assert got == {"a": "out", "b": "out", "c": "out", "d": "in"}


def test_threshold_and_combination(spark):
    rows = [(int(i % 3 == 0), (i % 100) / 100) for i in range(300)]
    df = spark.createDataFrame(rows, "label int, proba double")
    for bound in (0.01, 0.05, 0.3):
        want = max(t for t in range(1001) if sum(l == 1 and p < t / 1000 for l, p in rows) / 300 < bound)
        assert classify.fn_threshold(df, max_fn=bound).first().threshold == want / 1000
    got = spark.createDataFrame([("NA", 0), ("NA", 1), ("PB", 0), (None, 0), ("NA", None)], "pred_pillar string, pred_scope int").select(classify.combine()).collect()
    assert [r[0] for r in got] == [0, 1, 1, 1, 0]


def test_logistic_is_the_summed_loss_solution(spark):
    import numpy as np

    rnd = np.random.default_rng(0)
    x = rnd.normal(size=(200, 4))
    y = (x[:, 0] + 0.5 * rnd.normal(size=200) > 0.8).astype(float)
    df = classify.features(spark.createDataFrame([(i, y[i].item(), x[i].tolist()) for i in range(200)], "id int, label double, embeddings array<double>"))
    model = classify.logistic(df, 0.1)
    n1 = y.sum()
    w = np.where(y > 0, 200 / (2 * n1), 200 / (2 * (200 - n1)))
    z, design = np.zeros(5), np.c_[x, np.ones(200)]
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ z))
        penalty = np.diag([1.0] * 4 + [0]) / 0.1
        z -= np.linalg.solve(design.T @ (design * (w * p * (1 - p))[:, None]) + penalty, design.T @ (w * (p - y)) + penalty @ z)
    assert np.allclose(model.coefficients.toArray(), z[:4], atol=1e-4)


def test_labels_flow(spark):
    rows = [("a", 1, "PB", "t", "x", 2000, "US"), ("b", 1, "F", "t", "x", 2001, "US"), ("c", 1, "F", "t", "x", 2005, "CN"), ("d", None, "CC", "", None, 2000, None)]
    df = spark.createDataFrame(rows, "id string, family_id long, pillar_curated string, title string, abstract string, publication_year int, jurisdiction string").withColumn("scope_curated", F.lit("in"))
    sub = labels.PATENT_LABELS[3]
    assert {r.id for r in labels.automatic(labels.eligible(df, sub), sub).collect()} == {"a", "d"}
    asked = labels.to_ask(labels.eligible(df, sub), sub)
    assert {r.id for r in asked.collect()} == {"b"}
    spread = labels.spread(df, asked.select("group_key", "pillar_curated", F.lit("BF").alias("subpillar")), ["subpillar"])
    assert {(r.id, r.subpillar) for r in spread.collect()} == {("b", "BF"), ("c", "BF")}
