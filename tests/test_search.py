import random
import re

import pytest
from pyspark.sql import functions as F

from curatrix.operators.search import Both, Phrase, code_or_none, escaped, has_code, in_years, matches, parse, remote_query, written


def plain(tree):
    return tree.text if isinstance(tree, Phrase) else ["and" if tree.every else "or", *map(plain, tree.parts)]


def test_parse():
    assert plain(parse('"food" AND ("protein") AND ("a b" OR "c")')) == ["and", "food", "protein", ["or", "a b", "c"]]
    assert plain(parse('(\\"x\\" OR \\"y\\")')) == ["or", "x", "y"]
    assert plain(parse('"a" OR "b"')) == ["or", "a", "b"] and plain(parse('"a" or "b" and "c"')) == ["and", ["or", "a", "b"], "c"]
    assert plain(parse('"a" "b"')) == ["and", "a", "b"] and plain(parse(r'"say \"x\" [1] (\\)"')) == 'say "x" [1] (\\)'
    assert plain(parse('("a" AND "b") OR ("c" OR ("d" AND "e"))')) == ["or", ["and", "a", "b"], ["or", "c", ["and", "d", "e"]]]
    for bad in ('("a"', "word", '"a")', "()", '"a" AND', 'OR "a"', '("a" OR)', ""):
        with pytest.raises(ValueError):
            parse(bad)


def test_random_queries_by_brute_force(spark):
    rnd = random.Random(3)
    words = ["oat", "soy", 'q"t', "[x]", "a(b", "back\\s", "AND", "é"]

    def tree(depth):
        if depth == 0 or rnd.random() < 0.3:
            return Phrase(rnd.choice(words))
        return Both(tuple(tree(depth - 1) for _ in range(rnd.randint(2, 3))), rnd.random() < 0.5)

    def holds(t, text):
        return t.text.lower() in text if isinstance(t, Phrase) else (all if t.every else any)(holds(p, text) for p in t.parts)

    texts = [" ".join(rnd.sample(words, rnd.randint(0, 5))).upper() for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string").cache()
    for _ in range(40):
        t = tree(3)
        query = written(t)
        assert {r.id for r in df.where(matches(query, "t")).collect()} == {i for i, x in enumerate(texts) if holds(t, x.lower())}, query
        # what the service unescapes is a query of the same meaning
        inner = re.fullmatch(r'search patents for "((?:[^"\\]|\\.)*)" where publication_year in \[1:2\] return patents', remote_query(query, "patents", "patents", "publication_year", (1, 2)))[1]
        back = parse(re.sub(r"\\(.)", r"\1", inner))
        assert all(holds(back, x.lower()) == holds(t, x.lower()) for x in texts)
    assert escaped('a"b\\') == 'a\\"b\\\\'
    assert remote_query('"a"', "publications", "publications[id]", "year", (2000, 2001), "title_abstract_only") == 'search publications in title_abstract_only for "\\"a\\"" where year in [2000:2001] return publications[id]'


def test_matches_any_case_and_null(spark):
    df = spark.createDataFrame([(1, "Oat MILK", None), (2, None, "soy"), (3, "milk of soy", "x"), (4, None, None)], "id int, a string, b string")
    hit = lambda q: {r.id for r in df.where(matches(q, "a", "b")).collect()}
    assert hit('"milk"') == {1, 3}
    assert hit('("oat" OR "soy")') == {1, 2, 3}
    assert hit('"milk" AND "soy"') == {3}


def test_codes_and_years(spark):
    df = spark.createDataFrame([(1, None, 2000), (2, [], 2001), (3, ["A", None], 2002), (4, ["Z", None], None)], "id int, c array<string>, y int")
    assert {r.id for r in df.where(code_or_none("c", ["A", "B"])).collect()} == {1, 2, 3}
    assert {r.id for r in df.where(has_code("c", ["A"])).collect()} == {3}
    assert {r.id for r in df.where(in_years("y", 2000, 2001)).collect()} == {1, 2}
    assert df.where(F.lit(True)).count() == 4
