import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np

from curatrix.llm import queries, runs
from curatrix.llm.common import table


def brute_runs(words, shortest=6, repeats=4):
    """All stretches word by word; a stretch counts under its smallest period only."""
    n, out = len(words), []
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            s, e = i, j + q
            if j > i and e - s >= max(shortest, repeats * q) and not any(all(words[k] == words[k + p] for k in range(s, e - p)) for p in range(1, q)):
                out.append((s, e - s, q))
            i = j + 1
    return sorted(out)


def test_runs_by_brute_force():
    rnd = random.Random(1)
    for trial in range(600):
        words = []
        while len(words) < rnd.choice((0, 5, 30, 120)):
            part = [rnd.choice("ab" if trial % 3 else "abcdefgh") for _ in range(rnd.choice((1, 2, 3, 5, 9)))]
            words += part * rnd.choice((1, 1, 2, 4, 5, 7))
        assert runs.find_runs(runs.word_ids(words)) == brute_runs(words), words
        assert runs.find_runs(runs.word_ids(words), 2, 3) == brute_runs(words, 2, 3), words


def test_long_periods_pass_the_screen():
    rnd = random.Random(2)
    for q in (63, 64, 65, 127, 128, 200, 511, 700):
        part = [str(rnd.randint(0, 40)) for _ in range(q)]
        for before, extra in ((0, 0), (37, 5), (300, q - 1)):
            words = [str(-i) for i in range(before)] + part * 4 + part[:extra] + ["end"]
            got = runs.find_runs(runs.word_ids(words))
            assert (before, 4 * q + extra, q) in got
            assert got == [r for r in got if all(words[k] == words[k + r[2]] for k in range(r[0], r[0] + r[1] - r[2]))]
    # multiples of a short period, and a long period made of nearly periodic parts
    words = ["a", "b"] * 900
    assert runs.find_runs(runs.word_ids(words)) == [(0, 1800, 2)]
    words = ([*"ab"] * 40 + ["c"]) * 5
    assert runs.find_runs(runs.word_ids(words)) == brute_runs(words)


def test_stretches_and_planes():
    rnd = random.Random(3)
    for _ in range(500):
        bits = [rnd.random() < 0.7 for _ in range(rnd.randint(1, 90))]
        need = rnd.randint(1, 9)
        want, i = [], 0
        while i < len(bits):
            j = i
            while j < len(bits) and bits[j]:
                j += 1
            if j - i >= need:
                want.append((i, j))
            i = j + 1
        assert runs.long_stretches(sum(b << i for i, b in enumerate(bits)), need) == want
    ids = np.array([5, 0, 3, 7, 2], np.int32)
    assert [sum((p >> i & 1) << b for b, p in enumerate(runs.bit_planes(ids))) for i in range(5)] == ids.tolist()


def test_collapse():
    words = "x a b a b a b a b y z z z z z z".split()
    found = runs.find_runs(runs.word_ids(words))
    assert found == [(1, 8, 2), (10, 6, 1)] and runs.collapse(words, found) == "x a b y z".split()


def test_query_by_brute_force(spark, sf):
    rows = {r.doc_id: r for r in queries.op13_periodic_runs(spark, sf).collect()}
    docs = table(spark, sf, "documents").collect()
    assert len(rows) == len(docs)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    seen = 0
    for d in docs:
        words = [w for w in "".join(c if c not in "\t\n\x0b\x0c\r" else " " for c in d.text or "").split(" ") if w]
        h, n = zlib.crc32(str(d.doc_id).encode()), len(words)
        if n > 3000:
            continue  # brute force is quadratic
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        want, r = brute_runs(words), rows[d.doc_id]
        best = min(want, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=(None,) * 3)
        assert (r.n_runs, r.start, r.length, r.period) == (len(want), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if want else None)
        assert r.runs_sha256 == sha("".join(f"{s},{m},{q}\n" for s, m, q in want))
        gone = {i for s, m, q in want for i in range(s + q, s + m)}
        assert r.collapsed_sha256 == sha(" ".join(w for i, w in enumerate(words) if i not in gone))
        seen += bool(want)
    assert seen > 5


def test_odd_rows(spark, odd, docs):
    got = runs.run_report(runs.periodic_runs(odd)).collect()
    assert len(got) == 8 and all(r.n_runs is not None and r.runs_sha256 and r.collapsed_sha256 for r in got)
    assert runs.periodic_runs(odd.limit(0)).count() == 0
    long = runs.periodic_runs(docs([("the same words again " * 50_000) + "end", "a " * 300_000])).collect()
    assert [[tuple(x) for x in r.runs] for r in long] == [[(0, 200_000, 4)], [(0, 300_000, 1)]]
    assert [r.collapsed for r in long] == ["the same words again end", "a"]
    assert {queries.tail_repeats(None, ["a"])[0], *queries.tail_repeats(5, [])} == {"a"}
