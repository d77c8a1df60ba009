import random
import zlib

import numpy as np

from curatrix.llm import components, lsh, partenum, sharding
from curatrix.llm.common import numbered
from curatrix.llm.shingles import shingle_sets

# --- numbering, components ------------------------------------------------------------------------


def test_numbering_is_gapless(spark):
    rows = [(i % 3, i * 7 % 50) for i in range(50)] + [(None, 1), (0, None)]
    out = numbered(spark.createDataFrame(rows, "g int, k int"), ["k"], "g").collect()
    for g in (0, 1, 2, None):
        mine = sorted((r for r in out if r.g == g), key=lambda r: r._index)
        assert [r._index for r in mine] == list(range(len(mine)))
        keys = [-1 if r.k is None else r.k for r in mine]
        assert keys == sorted(keys)
    assert numbered(spark.createDataFrame([], "g int, k int"), ["k"]).count() == 0


def reach(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {x: find(x) for x in root}


def test_components(spark, monkeypatch):
    rnd = random.Random(0)
    edges = [(i, i + 1) for i in range(100, 140)] + [(rnd.randrange(60), rnd.randrange(60)) for _ in range(40)] + [(5, 5)]
    want = reach(e for e in edges if e[0] != e[1])
    for local in (components.LOCAL_EDGES, 0):  # one task, and rounds
        monkeypatch.setattr(components, "LOCAL_EDGES", local)
        got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
        assert got == {x: c for x, c in want.items() if x != c}
    assert components.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


# --- sharding -------------------------------------------------------------------------------------


def test_differencing_is_a_partition_near_the_best():
    rnd = random.Random(0)
    for k in (2, 3, 5):
        for _ in range(30):
            sizes = [rnd.randint(1, 100) for _ in range(rnd.randint(1, 9))]
            parts = [p[0] for p in sharding.difference([[s] + [0] * (k - 1) for s in sizes], k)]
            sums = [sum(s for s, p in zip(sizes, parts) if p == j) for j in range(k)]

            def best(i, now):
                return max(now) if i == len(sizes) else min(best(i + 1, now[:j] + [now[j] + sizes[i]] + now[j + 1 :]) for j in range(k))

            if len(sizes) <= 6:
                assert max(sums) <= 1.35 * best(0, [0] * k)
            # and never worse than a plain order allows
            assert max(sums) - min(sums) <= max(sizes)
    parts = sharding.difference([[5, 1, 0], [4, 4, 0], [3, 2, 1]], 3)
    assert all(sorted(p) == [0, 1, 2] for p in parts) and sharding.difference([], 3) == []


def test_shards(odd, docs):
    out = sharding.shard_documents(odd, 3).collect()
    assert len(out) == odd.count() and {r.law for r in out} == {"bytes"}
    rows = sorted(odd.select("doc_id", "text").collect(), key=str)
    assert sorted((str(r.doc_id), len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in rows) == sorted((str(r.doc_id), r.size, r.text_crc32) for r in out)
    rnd = random.Random(1)
    texts = [f"{rnd.randrange(40)} " * rnd.randint(1, 30) for _ in range(900)] + ["hot"] * 500
    table = docs(texts)
    out = sharding.shard_documents(table, 5).collect()
    shard = {}
    for r in out:
        assert shard.setdefault(texts[r.doc_id], r.shard) == r.shard
    for s in range(5):
        mine = sorted((r for r in out if r.shard == s), key=lambda r: r.slot)
        assert [r.slot for r in mine] == list(range(len(mine)))
        assert [r.doc_id for r in mine] == sorted(r.doc_id for r in mine)
    sums = [sum(r.size for r in out if r.shard == s) for s in range(5)]
    assert max(sums) - min(sums) < 0.02 * sum(sums)
    assert sharding.shard_documents(odd.limit(0), 3).count() == 0


# --- Jaccard --------------------------------------------------------------------------------------


def brute_sets(texts):
    out = []
    for t in texts:
        w = (t or "").encode().lower().split()
        out.append(frozenset(tuple(w[j : j + 5]) for j in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    return out


def near_texts(seed=0):
    rnd = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(3000)]
    passage = " ".join(rnd.choice(vocabulary) for _ in range(60))
    texts = []
    for n in (1, 2, 4, 5, 6, 7, 9, 15, 30, 80, 300):
        for _ in range(6):
            words = [rnd.choice(vocabulary) for _ in range(n)]
            texts.append(" ".join(words))
            for _ in range(rnd.randint(0, 4)):
                changed = list(words)
                for _ in range(max(1, n // 60)):
                    changed[rnd.randrange(n)] = rnd.choice(vocabulary)
                texts.append(" ".join(changed) if rnd.random() < 0.8 else " ".join(changed).upper() + "\n")
    texts += [passage + " " + " ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(0, 200))) for _ in range(60)]
    base = [rnd.choice(vocabulary) for _ in range(120)]
    for _ in range(80):  # a group of near copies
        base = list(base)
        base[rnd.randrange(120)] = rnd.choice(vocabulary)
        texts.append(" ".join(base))
    return texts + [None, "", "  ", "a a a a a a a a", "a a a a a", "A\x0ba\ta"]


def test_shingles_by_brute_force():
    import pyarrow as pa

    texts = near_texts(5) + ["é É x　y z", "one two three four five six"]
    values, at = shingle_sets(pa.array(texts, pa.string()))
    sets = brute_sets(texts)
    assert np.diff(at).tolist() == [len(s) for s in sets]
    ids = {}
    for i, s in enumerate(sets):
        mine = set(values[at[i] : at[i + 1]].tolist())
        for j in range(i):
            assert len(mine & ids[j]) == len(s & sets[j])
        ids[i] = mine
    sliced = pa.array([None, *texts], pa.string()).slice(1)
    assert (shingle_sets(sliced)[0] == values).all()


def links(sets):
    return [(a, b) for a in range(len(sets)) for b in range(a) if sets[a] and sets[b] and 4 * len(sets[a] & sets[b]) >= 3 * len(sets[a] | sets[b])]


def test_linked_pairs_share_a_signature():
    texts = near_texts(2)
    import pyarrow as pa

    values, at = shingle_sets(pa.array(texts, pa.string()))
    owner = np.repeat(np.arange(len(texts)), np.diff(at))
    plain = np.unique(values, return_counts=True)
    for common in (np.zeros(0, np.uint64), plain[0][plain[1] >= 3]):
        sig, ref = partenum.signatures(values, owner, np.diff(at), common, 3, 4)
        mine = [set(sig[ref == i].tolist()) for i in range(len(texts))]
        sets = brute_sets(texts)
        assert all(mine[a] & mine[b] for a, b in links(sets))
        # and far fewer pairs meet than there are
        met = sum(bool(mine[a] & mine[b]) for a in range(len(sets)) for b in range(a))
        assert met < 0.5 * len(sets) ** 2 / 2


def test_prefixes_of_partitions_lose_no_pair():
    rng = np.random.default_rng(7)
    for size in [1, 2, 5, 9, 17, 40, 97, 150, 260, 777, 1500]:
        # a pair as far apart as a link allows, and with one shingle more in the larger one
        sets = []
        for larger in {size, size * 7 // 6, size * 4 // 3}:
            pool = rng.permutation(np.unique(rng.integers(0, 1 << 64, 5 * size + 50, np.uint64)))
            both = -(-3 * (size + larger) // 7)
            if both <= size:
                sets += [np.sort(pool[:size]), np.sort(np.r_[pool[:both], pool[2 * size : 2 * size + larger - both]])]
        values, sizes = np.concatenate(sets), np.array([len(s) for s in sets])
        owner = np.repeat(np.arange(len(sets)), sizes)
        for common in (np.zeros(0, np.uint64), np.sort(values[rng.random(len(values)) < 0.4])):
            sig, ref = partenum.signatures(values, owner, sizes, common, 3, 4)
            mine = [set(sig[ref == i].tolist()) for i in range(len(sets))]
            assert all(mine[i] & mine[i + 1] for i in range(0, len(sets), 2))
            if size > 90 and not len(common):
                # a third of the size and one for each of two windows at most: what the distance asks for, not all partitions
                assert all(len(m) <= 2 * (n // 3 + 1) for m, n in zip(mine, sizes, strict=True))


def test_local_join_by_brute_force():
    import pyarrow as pa

    texts = near_texts(3)
    values, at = shingle_sets(pa.array(texts, pa.string()))
    got = partenum.link([values[at[i] : at[i + 1]] for i in range(len(texts))], 3, 4)
    want = reach(links(brute_sets(texts)))
    assert got == [want.get(i, i) for i in range(len(texts))]


def test_jaccard_classes(docs, odd, monkeypatch):
    texts = near_texts(4)
    texts += texts[:40]
    want = reach(links(brute_sets(texts)))
    sets = brute_sets(texts)
    for block in (2500, 20):  # whole components, and pairs of blocks
        monkeypatch.setattr(partenum, "BLOCK", block)
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in partenum.jaccard_classes(docs(texts)).collect()}
        assert got == {i: (len(sets[i]), want.get(i, i)) for i in range(len(texts))}
    kept = partenum.distinct_documents(docs(texts))
    assert {r.doc_id for r in kept.collect()} == {i for i in range(len(texts)) if want.get(i, i) == i} and kept.columns == docs([]).columns
    out = {(r.doc_id, r.component_id) for r in partenum.jaccard_classes(odd).collect()}
    assert out == {(0, 0), (1, 1), (2, 2), (3, 3), (None, None), (5, 5), (6, 3)}
    assert partenum.jaccard_classes(odd.limit(0)).count() == 0 and partenum.distinct_documents(odd).columns == odd.columns


def test_ties_connect_what_sketches_allow():
    rng = np.random.default_rng(3)
    sets = []
    for n in rng.choice([1, 3, 8, 20, 31, 33, 60, 64, 70, 128, 200, 600], 60):
        base = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        sets.append(base)
        for _ in range(rng.integers(0, 4)):
            more = rng.integers(0, 1 << 63, rng.integers(0, n // 5 + 2)).astype(np.uint64)
            sets.append(np.unique(np.concatenate([rng.permutation(base)[rng.integers(0, n // 3 + 1) :], more])))
    sets = [s for s in sets if len(s)]
    size = np.array([len(s) for s in sets])
    sketch = partenum.sketches(np.concatenate(sets), np.concatenate([[0], np.cumsum(size)]))

    def allowed(a, b):
        return 4 * min(size[a], size[b]) >= 3 * max(size[a], size[b]) and 7 * partenum.distance_bound(sketch[a], sketch[b]) <= size[a] + size[b]

    got = partenum.ties(sketch, size, 3, 4)
    assert len(got) > 20 and all(allowed(a, b) for a, b in got)
    assert reach(got) == reach((a, b) for a in range(len(sets)) for b in range(a) if allowed(a, b))
    assert partenum.ties([], size[:0], 3, 4) == [] and len(partenum.ties(sketch[:1] * 9, size[:1].repeat(9), 3, 4)) == 8


def test_a_passage_of_many_documents_ties_nothing(docs, monkeypatch):
    # too rare for the sample, which is empty here, and in more documents than give pairs
    rnd = random.Random(6)
    passage = " ".join(f"p{i}" for i in range(40))
    texts = [f"{passage} " + " ".join(f"v{rnd.randrange(10**6)}" for _ in range(30 + i % 60)) for i in range(150)]
    texts += [t + " more" for t in texts[:30]]
    want = reach(links(brute_sets(texts)))
    written = {}

    def stored(df, name, keep=partenum.stored):
        return written.setdefault(name, keep(df, name))

    monkeypatch.setattr(partenum, "stored", stored)
    monkeypatch.setattr(partenum, "SAMPLE_DOCS", 0)
    for group in (2000, 40):  # stars in one piece, and in blocks
        written.clear()
        monkeypatch.setattr(partenum, "GROUP", group)
        got = {r.doc_id: r.component_id for r in partenum.jaccard_classes(docs(texts)).collect()}
        assert got == {i: want.get(i, i) for i in range(len(texts))}
        assert written["met"].where("star").count() > 100
        assert max(r["count"] for r in written["candidate-classes"].groupBy("home").count().collect()) == 2


def test_rows_without_ids_are_not_sampled_or_linked(docs, spark):
    texts = [f"the same words stand here in row {i % 3} of the table" for i in range(30)]
    df = docs(texts).selectExpr("CAST(NULL AS bigint) AS doc_id", "text")
    out = partenum.jaccard_classes(df).collect()
    assert len(out) == 30 and all(r.doc_id is None and r.component_id is None and r.n_shingles for r in out)
    assert partenum.distinct_documents(df).count() == 30


# --- vectors --------------------------------------------------------------------------------------


def test_vectors_by_brute_force(spark, monkeypatch):
    rnd = np.random.default_rng(0)
    rows = []
    for label in (0, 1):
        for _ in range(30):
            c = rnd.normal(size=16)
            for _ in range(rnd.integers(1, 8)):
                v = c + rnd.normal(size=16) * rnd.choice([0.0, 0.05, 0.2, 0.3])
                rows.append((len(rows), (v * rnd.choice([1.0, 3.0])).astype(np.float32).tolist(), label))
    rows += [(900, [1.0] * 16, None), (901, None, 0), (902, [0.0] * 16, 0), (903, [float("nan")] * 16, 0), (904, [None] + [1.0] * 15, 0), (905, [1.0, 2.0], 0), (906, [2.0, 4.0], 0), (907, [], 1), (5, rows[5][1], rows[5][2]), (908, [float("inf")] + [1.0] * 15, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 AS code", "'x' AS t", "2 AS id")
    sound = [(i, np.array(v, float), l) for i, v, l in rows if l is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    pairs = [(a, b) for a in range(len(sound)) for b in range(a) if sound[a][2] == sound[b][2] and len(sound[a][1]) == len(sound[b][1]) and sound[a][1] @ sound[b][1] / np.linalg.norm(sound[a][1]) / np.linalg.norm(sound[b][1]) >= 0.93]
    n = {}
    for a, b in pairs:
        for x in (a, b):
            n[x] = n.get(x, 0) + 1
    want_links = {}
    for x, s in enumerate(sound):
        want_links.setdefault(s[0], []).append(n.get(x, 0))
    home = reach([(sound[a][0], sound[b][0]) for a, b in pairs])
    for block in (4096, 3):
        monkeypatch.setattr(lsh, "BLOCK", block)
        out = lsh.near_duplicate_vectors(df, 0.93, recall=0.99999).collect()
        assert len(out) == len(rows)
        for r in out:
            assert r.component_id == home.get(r.vec_id, r.vec_id) and r.kept == (r.vec_id == r.component_id)
            assert r.n_links in want_links.get(r.vec_id, [0]), r
    assert lsh.near_duplicate_vectors(df.limit(0)).count() == 0


def test_sketches_hold_the_codes_and_bound_the_angle():
    rnd = np.random.default_rng(3)
    codes = rnd.integers(0, 1 << 11, (50, 7))
    packed = lsh.packed_codes(codes, 11)
    assert (lsh.unpacked_codes(packed, 7) == codes).all()
    most = lsh.most_differing(0.93, 200)
    x = lsh.unit(rnd.normal(size=(2000, 64)))
    y = lsh.unit(x + rnd.normal(size=x.shape) * 0.048)
    close = (x * y).sum(1) >= 0.93
    apart = (lsh.sign_codes(x, 10, 20, 17) ^ lsh.sign_codes(y, 10, 20, 17))
    assert close.sum() > 500 and (np.bitwise_count(apart).sum(1)[close] <= most).mean() > 0.999


def test_recall_on_the_table(spark, sf):
    d = sf.replace("0.001", "0.1")
    df = spark.read.parquet(f"{d}/embeddings.parquet")
    p = df.toPandas()
    x = np.stack(p.embedding).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    close = (x @ x.T >= 0.93) & (p.label.values[:, None] == p.label.values)
    np.fill_diagonal(close, False)
    got = lsh.near_duplicate_vectors(df).toPandas().set_index("vec_id").loc[p.vec_id]
    assert (got.n_links.values <= close.sum(1)).all() and got.n_links.sum() >= 0.98 * close.sum()
