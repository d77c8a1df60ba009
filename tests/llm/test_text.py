import math
import random
import re
from collections import Counter
from itertools import product

import numpy as np
import pytest

from curatrix.llm import pii, quality, toxicity, wrapper

# --- quality --------------------------------------------------------------------------------------


def brute_counts(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]", text) if w]
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    grams = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    hit = {j for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(hit)]


def test_counts_by_brute_force():
    rnd = random.Random(0)
    for _ in range(2000):
        t = "".join(rnd.choice([*"ab# \n\t|é", "a b c ", "x\n", "\x0b", "　"]) for _ in range(rnd.randint(0, 50)))
        assert quality.measure(t)[0] == brute_counts(t), t


def test_binomial_tail_is_exact():
    for n, p in ((10, 0.3), (200, 0.05), (3000, 0.01)):
        for k in range(0, int(n * p) + 1, max(1, int(n * p) // 4)):
            exact = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
            assert abs(quality.binomial_cdf(k, n, p) - exact) < 1e-9 * exact + 1e-15


def test_certificates_hold_under_the_worst_case():
    # documents whose true rejection rate is just above the risk are certified at most delta of the time
    rnd = np.random.default_rng(0)
    wrong = sum(quality.certified(int(rnd.binomial(1000, 0.021)), 1000, 0.02, 0.05) for _ in range(2000))
    assert wrong / 2000 < 0.05


def test_path_lowers_the_cutoffs_that_pay():
    h = {(1, 2, 1): 5000, (1, 60, 0): 80, (1, 61, 1): 1, (2, 90, 0): 50, (4, 30, 0): 2, (5, 30, 0): 90, (5, 30, 1): 20}
    steps = quality.path(h)
    assert steps == [(2, 90), (1, 60)]  # 4 has too few bad documents, 5 costs too many good ones
    table = quality.steps_of(steps)
    assert table[1][59:62] == [2, 1, 1] and table[2][89:91] == [2, 0] and table[0] == [2] * 101


def test_choose_certifies_rules_jointly():
    paths = {"en": [(2, 90), (1, 60)], "de": [(1, 50)], "fr": [], "es": [(1, 5)], "other": []}
    # en: both steps hold; de: 90 good documents, none rejected, suffice at a third of delta; es: the step rejects too many
    counts = {("en", 0, 0): 50, ("en", 1, 0): 60, ("en", 1, 1): 2, ("en", 2, 1): 1000, ("de", 0, 0): 9, ("de", 1, 1): 90, ("es", 0, 0): 500, ("es", 0, 1): 40, ("es", 1, 1): 400}
    limits = quality.choose(paths, counts, 0.05, 0.05)
    assert limits.cutoffs == {("en", 2): 90, ("en", 1): 60, ("de", 1): 50}
    assert quality.choose(paths, counts | {("de", 1, 1): 40}, 0.05, 0.05).cutoffs == {("en", 2): 90, ("en", 1): 60}


def test_joint_false_rejections_stay_below_the_risk():
    # three rules that each reject 2.5% of good documents: together above 5%, certified at most delta of the time
    rnd, wrong = np.random.default_rng(0), 0
    for _ in range(1000):
        first = np.where(rnd.random((600, 3)) < 0.025, np.arange(3), 3).min(axis=1)
        counts = {("en", int(k), 1): int(n) for k, n in zip(*np.unique(first, return_counts=True), strict=True)} | {("en", k, 0): 200 for k in range(3)}
        wrong += len(quality.choose({"en": [(0, 50), (1, 50), (2, 50)]}, counts, 0.05, 0.05).cutoffs) == 3
    assert wrong / 1000 < 0.05


def test_cutoffs_by_brute_force(spark, sf):
    d = sf.replace("0.001", "0.1")
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    limits = quality.fit(quality.measured(docs), labels)
    assert {s for s, _ in limits.cutoffs} == set(quality.STRATA)
    rows = {r.doc_id: r for r in docs.collect()}
    kept = {r.doc_id: r.kept for r in quality.quality_report(docs, labels).collect()}
    for i, r in rows.items():
        counts, buckets = quality.measure(r.text)
        assert kept[i] == (not quality.base_failed(counts) and not any((r.lang, k) in limits.cutoffs and b >= limits.cutoffs[r.lang, k] for k, b in enumerate(buckets)))
    assert {r.doc_id for r in quality.quality_filter(docs, labels).select("doc_id").collect()} == {i for i, k in kept.items() if k}
    good = [r for r in labels.where("quality = 1").collect() if not quality.base_failed(quality.measure(rows[r.doc_id].text)[0])]
    for lang in quality.STRATA:
        own = [kept[r.doc_id] for r in good if rows[r.doc_id].lang == lang]
        assert own.count(False) <= 0.05 * len(own)


def test_quality_frames(odd, spark):
    labels = spark.createDataFrame([(3, 1, 0), (3, 0, 0), (None, 1, 0), (6, None, 0)], "doc_id long, quality int, toxic int")
    out = quality.quality_report(odd, labels).collect()
    assert len(out) == odd.count()
    for r in out:
        if r.doc_id in (0, 1, 5):
            assert r.n_words == 0 and r.base_failed and not r.kept
    kept = quality.quality_filter(odd, labels)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in out if r.kept}
    assert quality.quality_report(odd.limit(0), labels.limit(0)).count() == 0


# --- toxicity -------------------------------------------------------------------------------------


def examples(n=700, seed=0):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        toxic = int(rnd.random() < 0.5)
        words = rnd.choices(range(400), [1 / (1 + j) for j in range(400)], k=rnd.randint(0, 40))
        rows.append((i, toxic, Counter([f"t{j}" for j in words] + ["bad"] * (toxic and rnd.randint(0, 2)))))
    df = Counter(t for _, _, c in rows for t in c)
    return rows, {t: 3 * k for t, k in df.items()} | {"t399": 1}, 3 * n


def dense_scores(index, rows, df, total, emphasis, texts):
    """Scores by a matrix product over the full vocabulary, every step written out."""
    names = sorted({t for _, _, c in rows for t in c if df[t] >= 2})
    at = {t: i for i, t in enumerate(names)}
    has = np.array([[t in c for t in names] for _, _, c in rows])
    label = np.array([r[1] for r in rows])
    weight = np.array([math.log(1 + total / df[t]) for t in names])
    if emphasis:
        weight *= 1 + emphasis * toxicity.evidence(has[label == 1].sum(0), has.sum(0), label.mean())

    def unit(c):
        v = np.zeros(len(names))
        for t, k in c.items():
            if t in at:
                v[at[t]] = (1 + math.log(k)) * weight[at[t]]
        return v / (np.linalg.norm(v) or 1)

    matrix = np.array([unit(c) for _, _, c in rows])
    order = [int(np.flatnonzero(index.ids == r[0])[0]) for r in rows]
    out = []
    for text in texts:
        cosines = (matrix @ unit(Counter(toxicity.terms(text)))).round(12)
        near = sorted((i for i in range(len(rows)) if cosines[i] > 0), key=lambda i: (-cosines[i], order[i]))[: toxicity.NEAREST]
        power = sum(cosines[i] * index.mass[order[i]] for i in near)
        vote = sum(cosines[i] * index.mass[order[i]] * label[i] for i in near) / power if near else None
        out.append(index.rate if vote is None else 0.999 * np.interp(vote, *index.knots) + 0.001 * vote)
    return out


@pytest.mark.parametrize("emphasis", [0.0, toxicity.EMPHASIS])
def test_scores_are_those_of_the_full_product(emphasis, monkeypatch):
    monkeypatch.setattr(toxicity, "HEAD", 20)
    rows, df, total = examples()
    index = toxicity.build(rows, df, total, (3.0, 1.0), emphasis)
    rnd = random.Random(1)
    texts = [" ".join(rnd.choice(["bad", *(f"T{rnd.randrange(400)}" for _ in range(30))]) for _ in range(rnd.randint(0, 30))) for _ in range(200)] + ["", "unknown"]
    found = [x for x, _ in index.scores(texts)]
    assert np.allclose(found, dense_scores(index, rows, df, total, emphasis, texts), atol=1e-9)
    assert index.scores(texts[::-1])[-1][0] == pytest.approx(found[0], abs=1e-12)


def test_blocks_are_passed_over(monkeypatch):
    monkeypatch.setattr(toxicity, "HEAD", 0)
    rows, df, total = examples(3000)
    index = toxicity.build(rows, df, total)
    seen = []
    real = toxicity.spans
    monkeypatch.setattr(toxicity, "spans", lambda a, z: seen.append(int((z - a).sum())) or real(a, z))
    index.judge([Counter(["bad", "t300"])])
    assert sum(seen[1:]) < sum((index.begin[i + 1] - index.begin[i]) * toxicity.BLOCK for i in (index.number["bad"], index.number["t300"]))


def test_almost_all_documents_have_a_vector(spark, sf):
    d = sf.replace("0.001", "0.01")
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    index = toxicity.fit(docs, labels)
    texts = [r.text for r in docs.where("text <> ''").select("text").collect()]
    assert sum(len(index.vector(Counter(toxicity.terms(t)))[0]) == 0 for t in texts) < len(texts) / 100


def test_isotonic_pools():
    x, y = toxicity.isotonic(np.array([0.1, 0.2, 0.3, 0.3]), np.array([0, 1.0, 0, 1]), np.array([1.0, 1, 2, 1]))
    assert (np.diff(y) >= 0).all() and x.tolist() == [0.1, 0.1, 0.2, 0.3] and y[-1] == 0.5


def test_held_out_accuracy(spark, sf):
    d = sf.replace("0.001", "0.1")
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    rows = toxicity.toxicity_scores(docs, labels).where("held_out").join(labels, "doc_id").select("toxic", "score", "predicted").toPandas()
    bad, good = rows[rows.toxic == 1], rows[rows.toxic == 0]
    assert (bad.predicted == 1).mean() > 0.85 and (good.predicted == 0).mean() > 0.98
    auc = ((bad.score.values[:, None] > good.score.values) + 0.5 * (bad.score.values[:, None] == good.score.values)).mean()
    assert auc > 0.967


def test_toxicity_frames(odd, spark):
    labels = spark.createDataFrame([(3, 1, 0), (3, 1, 1), (6, 1, 0), (None, 0, 1), (2, 0, None)], "doc_id long, quality int, toxic int")
    out = toxicity.toxicity_scores(odd, labels).collect()
    assert len(out) == odd.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    assert all(r.score == 0 for r in toxicity.toxicity_scores(odd, labels.limit(0)).collect())
    assert toxicity.toxicity_filter(odd, labels).columns == odd.columns
    assert toxicity.toxicity_scores(odd.limit(0), labels).count() == 0


def test_terms_are_counted_over_all_documents(docs, spark):
    texts = [f"vile words {i}" if i % 2 else f"kind words {i}" for i in range(200)]
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(200)], "doc_id long, quality int, toxic int")
    index = toxicity.fit(docs(texts), labels, 2, emphasis=0.0)
    assert len(index.ids) == 4 and set(index.number) == {"vile", "kind", "words"}
    for term, n in (("vile", 100), ("kind", 100), ("words", 200)):
        assert abs(index.weight[index.number[term]] - math.log(1 + 200 / n)) < 1e-12


def test_examples_are_bounded_by_characters(docs, spark, monkeypatch):
    monkeypatch.setattr(toxicity, "EXAMPLE_CHARS", 40)
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(60)], "doc_id long, quality int, toxic int")
    index = toxicity.fit(docs(["ten chars " * (1 + 50 * (i % 7 == 0)) for i in range(60)]), labels)
    assert len(index.ids) == 8


# --- personal data --------------------------------------------------------------------------------

BASE = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def brute_spans(t):
    out = []
    for kind, pattern in enumerate(BASE):
        for m in re.finditer(pattern, t):
            digits = [c for c in m[0] if c in "0123456789"]
            if kind == 1 and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == 2 and not (14 <= len(digits) <= 19 and pii.luhn("".join(digits))):
                continue
            if kind == 3 and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda s: (s[0], s[2]))


def test_base_patterns_by_brute_force():
    rnd = random.Random(3)
    parts = ["1", "2", "25", "300", ".", " ", "-", "+", "(", ")", "a", "@", "b.c", "%", "4111 1111 1111 1111", "é", "@@", "1.2.3.4"]
    for _ in range(20_000):
        t = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 16)))
        assert pii.base_spans(t) == brute_spans(t), t


def test_long_runs_stay_linear():
    for t in ("1" * 200_000, "1." * 100_000, "a" * 200_000 + "@", "a@" * 50_000, "+1(" * 50_000, "1 " * 100_000):
        pii.base_spans(t)


def test_crf_sums_over_all_segmentations():
    model = pii.SemiCRF({"a": 0.7, "b": -0.4, "c": 1.3})
    segments = [(0, 2, 0, ["a"]), (1, 3, 1, ["b"]), (1, 2, 2, ["c"]), (2, 4, 0, ["a", "b"]), (3, 4, 3, ["c"])]

    def all_sets(at):
        yield []
        for k, s in enumerate(segments):
            if s[0] >= at:
                yield from ([k, *rest] for rest in all_sets(s[1]))

    weight = {tuple(x): math.exp(sum(model.score(segments[k][3]) for k in x)) for x in all_sets(0)}
    z = sum(weight.values())
    p, log_z = model.marginals(4, segments)
    assert abs(log_z - math.log(z)) < 1e-9
    for k in range(len(segments)):
        assert abs(p[k] - sum(w for x, w in weight.items() if k in x) / z) < 1e-9
    assert tuple(model.best(4, segments)) == max(weight, key=weight.get)


def test_crf_adds_and_spares():
    model = pii.trained()
    for text, want in (
        ("call (454) 555-9913 now", "(454) 555-9913"),
        ("mail jane.doe [at] example [dot] org today", "jane.doe [at] example [dot] org"),
        ("card 4111.1111.1111.1111 ok", "4111.1111.1111.1111"),
    ):
        assert [text[a:z] for a, z, _ in pii.find_spans(text, model)[1]] == [want]
    for text in ("password=da3fe1beadc3e135f8", 'token = "a2cc176fae2bbfbf1e5952991985e9ec519d6afc"', "version 1.2.3 of 2020-01-02", "4111111111111112", "12,345.67 units", "look at page 300", "300.400.500.600"):
        assert not pii.find_spans(text, model)[1], text
    held = pii.training_phrases(seed=99, n=150)
    hit = miss = extra = 0
    for text, spans in held:
        got = set(pii.find_spans(text, model)[1])
        hit, miss, extra = hit + len(set(spans) & got), miss + len(set(spans) - got), extra + len(got - set(spans))
    assert hit > 0.75 * (hit + miss) and extra < 0.15 * (hit + extra)


def test_crf_sees_every_candidate_of_digits():
    model = pii.trained()
    name = "x" * 40
    for text, want in (
        ("host 10[.]0[.]0[.]5 up", "10[.]0[.]0[.]5"),
        ("call 06 12 34 56 78 now", "06 12 34 56 78"),
        (f"mail a [at] {name} [dot] org", f"a [at] {name} [dot] org"),
    ):
        assert [text[a:z] for a, z, _ in pii.find_spans(text, model)[1]] == [want]
    rnd = random.Random(5)
    parts = ["1", "23", "456", ".", "[.]", " ", "+", "(", ")", "-", "_", " word ", "²", "\n"]
    for _ in range(2000):
        t = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 60)))
        cut, regions = pii.atoms(t), pii.regions(t)
        for i, j, _, _ in pii.candidates(t, cut):
            assert "²" in t or any(a <= cut[i][0] and cut[j - 1][1] <= z for a, z in regions), t


@pytest.mark.parametrize("digit", ["", " 7"])
def test_spelled_out_addresses_without_digits(digit):
    model = pii.trained()
    for address in ("jane.doe [AT] example [DOT] org", "jane.doe (AT) example (DOT) org", "jane [At] example [dot] org"):
        text = f"write {address} today{digit}"
        assert [text[a:z] for a, z, _ in pii.find_spans(text, model)[1]] == [address]


def test_every_trigger_is_looked_at():
    class Seen(Exception):
        pass

    class Model:
        def marginals(self, n, segments):
            raise Seen

    for text in ("jane AT example DOT org", "jane{at}example{dot}org", "jane\nat\nexample\ndot\norg", "jane\tat\texample\tdot\torg"):
        with pytest.raises(Seen):
            pii.find_spans(text, Model())


def test_base_spans_stay(spark, sf):
    model = pii.trained()
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        base, spans = pii.find_spans(r.text or "", model)
        assert set(base) <= set(spans) and base == brute_spans(r.text or "")


def test_personal_data_frames(odd, docs):
    out = pii.personal_data(odd).collect()
    assert len(out) == odd.count() and all(r.base_sha256 for r in out)
    masked = pii.mask(docs(["mail a@b.co or +1 (454) 555-9913", None, ""])).collect()
    assert masked[0].text == "mail [EMAIL] or [PHONE]" and masked[0].n_chars == len(masked[0].text)
    assert masked[1].text is None and masked[2].text == ""
    assert pii.mask(odd).columns == odd.columns and pii.personal_data(odd.limit(0)).count() == 0


# --- wrappers -------------------------------------------------------------------------------------


def page(article, nav="a b", extra=""):
    return f"<html><head><title>t</title><style>p{{}}</style></head><body><nav><ul><li>{nav}</li></ul></nav><div class='ad'>buy</div><div id=wrap><div class='post'>{article}</div><div class='comments'><p>me too</p></div>{extra}</div><footer>&copy; x</footer></body></html>"


def test_parser_and_blocks():
    root = wrapper.parse("<body><p>a &amp; b<br>c<p><b>d <i>e</b> f<ul><li>g<li>h</ul><script>if (a<b) '</p>'</script><!-- x --><div>i</div> j")
    assert wrapper.blocks(root) == ["a & b c", "d e f", "g", "h", "i", "j"]
    assert wrapper.extract("<div>" * 5000 + "deep") == "deep"
    assert wrapper.extract("<p title='a>b'>x</p") == "x"
    assert wrapper.extract(None, None) == "" and wrapper.extract("", None) == ""


def test_wrapper_finds_the_slot_and_the_constants():
    bodies = [f"<h2>Story {i}</h2>" + "".join(f"<p>text {i} {j} about {i * 7 + j} things</p>" for j in range(4)) + "<p>Read our terms.</p>" for i in range(4)]
    pages = [page(b, nav=f"n{i}") for i, b in enumerate(bodies)]
    path, constant = wrapper.induce(pages)
    assert path[-1] == "div.post" and constant == ["Read our terms."]
    got = wrapper.extract(pages[1], path, frozenset(constant))
    assert got.split("\n\n") == ["Story 1", *[f"text 1 {j} about {7 + j} things" for j in range(4)]]
    assert wrapper.induce(pages[:1]) is None and wrapper.induce([pages[0], pages[0].replace("n0", "n9")]) is None


def test_simple_tree_matching_by_brute_force():
    rnd = random.Random(0)

    def tree(n):
        node = wrapper.Node(rnd.choice("ab"))
        while n > 0:
            k = rnd.randint(1, n)
            node.children.append(tree(k - 1))
            n -= k
        return node

    def size(a, b):
        if a.tag != b.tag:
            return 0

        def forest(x, y):
            if not x or not y:
                return 0
            return max(forest(x[1:], y), forest(x, y[1:]), size(x[0], y[0]) + forest(x[1:], y[1:]))

        return 1 + forest(a.children, b.children)

    for _ in range(150):
        a, b = tree(6), tree(6)
        n, pairs = wrapper.match(a, b)
        assert n == size(a, b) == len(pairs)


def test_wrapper_frames(spark):
    pages = spark.createDataFrame([(i, f"https://h.example/{i}", page(f"<p>alpha {i}</p><p>beta {i} gamma</p>", str(i))) for i in range(5)] + [(5, None, page("<p>x</p>")), (6, "nohost", None), (7, "https://h.example/7", ""), (0, "https://h.example/0", page("<p>alpha 0</p><p>beta 0 gamma</p>", "0"))], "page_id long, url string, html string").selectExpr("*", "'a' AS host", "'b' AS wrapper")
    out = {(r.page_id, r.text) for r in wrapper.main_texts(pages).collect()}
    assert out >= {(i, f"alpha {i}\n\nbeta {i} gamma") for i in range(5)} | {(6, ""), (7, "")}
    assert wrapper.main_texts(pages).count() == 9 and wrapper.main_texts(pages.limit(0)).count() == 0


def test_long_and_deep_pages_are_aligned_whole():
    def long(i):
        return "<html><body>" + "".join(f"<hr class=x{j % 3}>" for j in range(300)) + f"<div class='post'><p>text {i}</p><p>more {i} of it</p></div></body></html>"

    def deep(i):
        return "<html><body>" + "<div>" * 100 + f"<div class='post'><p>text {i}</p><p>more {i} of it</p></div></body></html>"

    for make in (long, deep):
        path, _ = wrapper.induce([make(i) for i in range(4)])
        assert path[-1] == "div.post"
    a, b = (wrapper.parse("<div>" * n) for n in (4000, 5000))
    assert wrapper.match(a, b)[0] == len(wrapper.match(a, b)[1]) == 4001


def test_slugs_in_ids_are_content(spark):
    slugs = '<h2 id="related-work">Related work</h2><section id="search-algorithms"><p>trees</p></section><h2 id="notice-of-meeting">Notice</h2><h3 id="comments">Remarks</h3><div id="social-history"><p>past</p></div><div class="share-price"><p>price</p></div>'
    want = ["Related work", "trees", "Notice", "Remarks", "past", "price"]
    chrome = '<div id="comments"><p>x</p></div><div class="cookie-banner"><p>y</p></div>'
    assert wrapper.extract(f"<body><article>{slugs}{chrome}</article>").split("\n\n") == want
    # a class with a chrome word is chrome in the content if it stands there in other pages as well
    htmls = [page(f"<p>text {i} of the host</p><div class='post-share-x'><p>tell {i} others</p></div>" + (slugs if not i else "")) for i in range(8)]
    pages = spark.createDataFrame([(i, f"https://h.example/{i}", h) for i, h in enumerate(htmls)], "page_id long, url string, html string")
    out = {r.page_id: r.text.split("\n\n") for r in wrapper.main_texts(pages).collect()}
    assert out == {i: [f"text {i} of the host", *(want if not i else [])] for i in range(8)}


def test_wrapper_of_a_host_of_copies(spark):
    # near copies with other adverts are most pages; one odd page lacks the constant
    def story(i, extra=""):
        return "".join(f"<p>text {i} {j} about {i * 7 + j} things</p>" for j in range(4)) + extra

    terms = "<p>Read our terms.</p>"
    htmls = [page(story(0, f"<p>offer {i}</p>" + terms), f"n{i}") for i in range(400)] + [page(story(i, terms), f"n{i}") for i in range(1, 20)] + [page(story(20))]
    pages = spark.createDataFrame([(i, f"https://h.example/{i}", h) for i, h in enumerate(htmls)], "page_id long, url string, html string").repartition(4)
    out = {r.page_id: r.text.split("\n\n") for r in wrapper.main_texts(pages).collect()}
    for i in range(1, 21):
        assert out[399 + i] == [f"text {i} {j} about {i * 7 + j} things" for j in range(4)]
    assert out[7] == [*(f"text 0 {j} about {j} things" for j in range(4)), "offer 7"]


def test_pages_of_the_tables(spark, sf):
    d = sf.replace("0.001", "0.01")
    pages = spark.read.parquet(f"{d}/pages.parquet")
    html = {r.page_id: r.html for r in pages.collect()}
    import html as entities

    for r in wrapper.main_texts(pages).collect():
        body = re.search(r"<article>(.*?)(?:</article>|$)", html[r.page_id], re.S)[1]
        parts = (" ".join(entities.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", body))
        assert r.text == "\n\n".join(p for p in parts if p) and r.n_chars == len(r.text)


@pytest.mark.parametrize("value", list(product((None, "", "x"), repeat=1)))
def test_single_texts(value):
    assert quality.measure(value[0] or "")[0][0] in (0, 1)


def test_attributes_as_browsers_read_them():
    text = lambda html: "\n\n".join(wrapper.blocks(wrapper.parse(html)))
    assert text("<p title=it's>One</p><p>Two don't three</p>") == "One\n\nTwo don't three"
    assert text('A <a href="x>y</a> z') == "A"  # the quote is never closed: the tag runs to the end of the page
    assert text('A <a href="x>y</a> z" class=b>link</a> B') == "A link B"
    assert text("""<p data-x='a>b' q"r = "c>d" e=f'g">One</p>""") == "One"
    assert text("<p =x / y = >One</p><p a= b>Two</p>") == "One\n\nTwo"
    assert text("<p title='class=menu id=nav'>One</p><p class=a class=menu>Two</p>") == "One\n\nTwo"
    assert text("<p CLASS = 'Menu'>One</p><p role=\"navigation\">Two</p><p>Three</p>") == "Three"
    assert text("<p>1 < 2 and <3</p><p x='' y>One</p>") == "1 < 2 and <3\n\nOne"
    long = "<p " + "a='b' " * 100_000 + ">One</p>" + "<" * 50_000 + "<p>Two</p>"
    assert text(long).startswith("One") and text(long).endswith("Two")
