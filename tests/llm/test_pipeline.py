import corpus_pipeline
from curatrix.llm import partenum, pii, quality, toxicity
from curatrix.llm.common import table
from curatrix.llm.queries import queries


def test_stages_by_brute_force(spark, sf):
    labels = table(spark, sf, "labels")
    docs = table(spark, sf, "documents")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "toxicity", "n-gram Jaccard join", "personal data", "best-fit packing"]
    rows = {r.doc_id: r for r in docs.collect()}
    limits = quality.fit(quality.measured(docs), labels)
    good = {i for i, r in rows.items() if not quality.base_failed((m := quality.measure(r.text or ""))[0]) and not limits.rejects(quality.stratum_of(r.lang), m[1])}
    steps = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        steps[name] = {r.doc_id: r for r in docs.collect()}
    assert set(steps["quality rules"]) == good
    index = toxicity.fit(corpus_pipeline.quality(spark, table(spark, sf, "documents"), sf), labels)
    calm = {i for i in good if index is None or index.scores([rows[i].text])[0][0] < 0.5}
    assert set(steps["toxicity"]) == calm
    sets = {i: frozenset(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))) for i in calm if (w := rows[i].text.encode().lower().split())}
    home = {i: i for i in calm}

    def find(x):
        while home[x] != x:
            x = home[x]
        return x

    for a in sets:
        for b in sets:
            if b < a and 4 * len(sets[a] & sets[b]) >= 3 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                home[max(x, y)] = min(x, y)
    assert set(steps["n-gram Jaccard join"]) == {i for i in calm if find(i) == i}
    model = pii.trained()
    for i, r in steps["personal data"].items():
        assert (r.text == rows[i].text) == (not pii.find_spans(rows[i].text, model)[1])
    packed = corpus_pipeline.run(spark, sf).collect()
    assert {r.doc_id for r in packed} == set(steps["personal data"])
    per = {}
    for r in packed:
        per.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all(sum(n for _, n in v) <= 1024 for v in per.values())


def test_odd_rows_go_through(spark, docs, sf):
    df = docs([None, "", "x", "word " * 60, "a b c d e f " * 30], [0, None, 2, 3, 3])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, df, sf)
        assert out.columns == df.columns
        out.collect()
        assert stage(spark, df.limit(0), sf).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, df, sf).count() == 5
    assert partenum.distinct_documents(df).count() == 5


def test_a_query_for_each_operator():
    assert [n.split("_")[0] for n in queries()] == [f"op{i}" for i in range(1, 14)]
