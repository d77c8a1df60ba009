import random
import zlib

import numpy as np
import pytest

from curatrix.llm import langid, queries
from curatrix.llm.common import table


def cuts(word, vocab):
    """All ways to cut a word into pieces."""
    if not word:
        yield []
    for k in range(1, len(word) + 1):
        if word[:k] in vocab:
            yield from ([vocab[word[:k]], *rest] for rest in cuts(word[k:], vocab))


PIECES = [b" ", b"a", b"b", b"c", b"ab", b" a", b"bc", b"abc", b"ca", b" ab"]
NUMBERS = {p: i for i, p in enumerate(PIECES)}
VOCAB = langid.Vocabulary(PIECES)


def test_forward_sums_all_cuts():
    rnd, gen = random.Random(0), np.random.default_rng(0)
    pieces = gen.dirichlet(np.ones(len(PIECES)), 3).T
    words = ["".join(rnd.choice("abc") for _ in range(rnd.randint(1, 9))) for _ in range(200)]
    got = langid.log_probabilities(words, VOCAB, pieces)
    for w, row in zip(words, got, strict=True):
        want = sum(np.prod(pieces[c], axis=0) for c in cuts(b" " + w.encode(), NUMBERS))
        assert np.allclose(np.exp(row), want)


def test_very_long_words_do_not_underflow():
    pieces = np.full((len(PIECES), 2), [[1e-9, 1e-7]])
    one, two = (langid.log_probabilities(["abc" * n], VOCAB, pieces)[0] for n in (300, 600))
    assert np.isfinite(one).all() and np.allclose(two / one, 2, atol=0.02) and one[1] > one[0]


def test_expected_uses_by_enumeration():
    rnd, gen = random.Random(1), np.random.default_rng(1)
    pieces = gen.dirichlet(np.ones(len(PIECES)), 2).T
    words = [b" " + "".join(rnd.choice("abc") for _ in range(rnd.randint(1, 7))).encode() for _ in range(60)]
    lang, count = gen.integers(0, 2, 60), gen.integers(1, 9, 60).astype(float)
    want = np.zeros_like(pieces)
    for w, k, n in zip(words, lang, count, strict=True):
        ways = list(cuts(w, NUMBERS))
        weights = np.array([np.prod(pieces[c, k]) for c in ways])
        for c, share in zip(ways, weights / weights.sum() * n, strict=True):
            for p in c:
                want[p, k] += share
    assert np.allclose(langid.expected_uses(words, lang, count, VOCAB, pieces), want)
    assert np.allclose(langid.smoothed(want).sum(axis=0), 1)


def test_words():
    assert langid.words_of("Été 12 don't_x ² ½") == ["été", "don", "t", "x", "²", "½"]
    assert langid.words_of("12 ² ½ _ --") == [] == langid.words_of("")


@pytest.fixture(scope="module")
def scored(spark):
    d = "/root/testdata/sf0.01"
    return table(spark, d, "documents").collect(), {r.doc_id: r for r in queries.op12_language_id(spark, d).collect()}


def test_held_out_accuracy(scored):
    docs, rows = scored
    assert len(docs) == len(rows)
    assert all(rows[d.doc_id].held_out == (zlib.crc32(str(d.doc_id).encode()) % 4 == 2) for d in docs)
    held = [d for d in docs if rows[d.doc_id].held_out]
    assert sum(rows[d.doc_id].lang_pred == d.lang for d in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 and r.lang_pred in ("en", "de", "fr", "es") for r in rows.values())


def test_held_out_labels_and_other_columns_are_not_seen(spark, scored):
    docs, rows = scored
    changed = [(d.doc_id, d.text, "xx" if rows[d.doc_id].held_out else d.lang, "q") for d in docs]
    again = langid.languages(spark.createDataFrame(changed, "doc_id long, text string, lang string, source string"), queries.MULTILINGUAL).collect()
    assert {r.doc_id: (r.lang_pred, r.score) for r in again} == {i: (r.lang_pred, r.score) for i, r in rows.items()}


def test_odd_rows(spark, odd):
    got = [(r.doc_id, r.held_out, r.lang_pred, r.score) for r in langid.languages(odd, queries.MULTILINGUAL).collect()]
    assert len(got) == 8 and {p for i, _, p, _ in got if i in (0, 1, 5)} == {"und"} and {p for i, _, p, _ in got if i in (2, 3, None, 6)} == {"en"}
    assert all(s == 0 for *_, p, s in got if p == "und") and (None, False, "en", 1.0) in got
    assert langid.languages(odd.limit(0), queries.MULTILINGUAL).count() == 0
    unlabelled = langid.languages(odd.selectExpr("doc_id", "text", "cast(null as string) AS lang"), queries.MULTILINGUAL).collect()
    assert {(r.lang_pred, r.score) for r in unlabelled} == {("und", 0.0)}
    one = spark.createDataFrame([(1, "x" * 20_000 + " the end", "en"), (4, "le " * 50_000, "fr")], "doc_id long, text string, lang string")
    assert langid.languages(one, queries.MULTILINGUAL).count() == 2
