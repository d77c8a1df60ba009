import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from curatrix.llm import queries, resample
from curatrix.llm.common import table

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute(docs, target, percent, seed, orders, buckets, least):
    """All features of all texts, each hashed where it is met; docs: (id, text)."""

    def features(text):
        w = WORD.findall(lower(text))
        return len(w), [zlib.crc32(" ".join(w[i : i + k]).encode()) % buckets for k in range(orders[0], orders[1] + 1) for i in range(len(w) - k + 1)]

    found = {i: features(t) for i, t in docs}
    s, t = Counter(b for _, f in found.values() for b in f), Counter(b for x in target for b in features(x)[1])
    ns, nt = s.total(), t.total()
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * (ns + buckets) / ((s[b] + 1.0) * (nt + buckets)))) for b in range(buckets)]
    rows = {}
    for i, (n, f) in found.items():
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows[i] = [len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n]
    able = sorted((i for i, r in rows.items() if r[3] >= least), key=lambda i: (-rows[i][2], i is not None, i))
    ranks = {i: k + 1 for k, i in enumerate(able[: percent * len(able) // 100])}
    return {i: (*r[:3], ranks.get(i)) for i, r in rows.items()}


@pytest.mark.parametrize("orders", [(1, 1), (1, 3), (2, 2), (2, 3)])
def test_features_of_all_orders_by_brute_force(spark, docs, orders):
    rnd = random.Random(5)
    texts = [" ".join(rnd.choice(["Ab", "b", "c1", "dé", "e-f", "Straße", "x"]) + rnd.choice([" ", ", ", "\n"]) for _ in range(rnd.choice((0, 1, 2, 9, 60)))) for _ in range(80)]
    target = ["c1 dé c1 dé b b x", "", None, "ab C1"]
    frame = spark.createDataFrame([(x,) for x in target], "text string")
    got = resample.importance_resample(docs(texts), frame, percent=35, seed="7", orders=orders, buckets=97, least_words=3, block_bytes=2000).collect()
    assert {r.doc_id: (r.n_features, r.weight, r.score, r["rank"]) for r in got} == brute(enumerate(texts), target, 35, "7", orders, 97, 3)


def test_query_by_brute_force(spark, sf):
    docs = [(r.doc_id, r.text) for r in table(spark, sf, "documents").collect()]
    want = brute(docs, [r.text for r in table(spark, sf, "benchmark").collect()], 10, "2024", (1, 1), 10_000, 20)
    got = queries.op11_importance_resampling(spark, sf).collect()
    assert {r.doc_id: (r.n_features, r.weight, r.score, r["rank"]) for r in got} == want
    assert any(r["rank"] for r in got)


def test_words_of_any_length_in_parts(monkeypatch):
    monkeypatch.setattr(resample, "PIECE", 16)
    rnd = random.Random(6)
    for _ in range(500):
        t = "".join(rnd.choice("aB9é .\n\x00-") if rnd.random() < 0.8 else "z" * rnd.randint(1, 40) for _ in range(rnd.randint(0, 60)))
        assert [w.decode() for part in resample.split_words(t.encode()) for w in part] == WORD.findall(lower(t))


def test_distinct_words_travel_once_a_block(spark, docs):
    blocks = resample.in_blocks(docs(["a b a", "b b c"] * 10).coalesce(1).selectExpr("doc_id", "cast(text as binary)"), 1, 1, 60)
    words = blocks.where("word is not null")
    assert blocks.where("grams is not null").count() == 20 and words.count() == words.select("block", "word").distinct().count() == 2 * 3
    assert words.selectExpr("sum(n)").first()[0] == 60


def test_odd_rows(spark, odd):
    target = spark.createDataFrame([("plain text",)], "text string")
    got = resample.importance_resample(odd, target, percent=100, least_words=1).collect()
    assert len(got) == 8 and sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 6)) and all(r.score is not None for r in got)
    assert all((r.n_features, r.weight, r["rank"]) == (0, 0, None) for r in got if r.doc_id in (0, 1, 5))
    twice = [r for r in got if r.doc_id == 2]
    assert len({r.score for r in twice}) == 1 and abs(twice[0]["rank"] - twice[1]["rank"]) == 1
    assert resample.importance_resample(odd.limit(0), target).count() == 0
    assert resample.importance_resample(odd, target.limit(0)).count() == 8
    assert resample.importance_resample(odd, target, percent=0).where("rank is not null").count() == 0
