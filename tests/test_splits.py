import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from curatrix.operators import splits


def key(i, seed=42):
    return int(hashlib.md5(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:15], 16)


def rows_of(spark, n=2000):
    strata = ["a"] * (n // 2) + ["b"] * (n // 3) + [None] * (n // 9) + ["c"] * 3
    return spark.createDataFrame([(i, strata[i % len(strata)], "x") for i in range(n)], "id long, label string, is_there string").cache()


@pytest.mark.parametrize("bucket", [10_000, 3])
def test_split_by_sorting(spark, monkeypatch, bucket):
    monkeypatch.setattr(splits, "BUCKET_ROWS", bucket)
    df = rows_of(spark)
    sizes = Counter(r.label for r in df.collect())
    for share in (0.2, 0.0, 1.0, 0.333):
        got = splits.split(df, "id", share, "label")
        assert got.columns == ["id", "label", "is_there", "is_test"]
        rows, quota = got.collect(), splits.quotas(sizes, share)
        for s in sizes:
            order = sorted((r.id for r in rows if r.label == s), key=lambda i: (key(i), str(i)))
            assert {r.id for r in rows if r.label == s and r.is_test} == set(order[: quota[s]])
        assert abs(sum(quota.values()) - share * len(rows)) < 1


def test_quotas():
    assert splits.quotas({"a": 10, "b": 5}, 0.2) == {"a": 2, "b": 1}
    assert sum(splits.quotas({"a": 10, "b": 5, None: 1}, 0.3).values()) == 5
    assert splits.quotas({}, 0.5) == {} and splits.quotas({"a": 1}, 1.0) == {"a": 1}
    with pytest.raises(ValueError):
        splits.split(None, "id", 2.0)


def test_split_without_strata_and_of_odd_rows(spark):
    df = spark.createDataFrame([(None, "a"), (1, "a"), (1, "a"), (2, None), (3, None)], "id long, label string")
    got = splits.split(df, "id", 0.5).collect()
    assert len(got) == 5 and len({r.is_test for r in got if r.id == 1}) == 1
    assert splits.split(df.limit(0), "id", 0.5, "label").count() == 0
    # another seed is another shuffle, the same seed the same
    many = rows_of(spark)
    a, b, c = ({r.id for r in splits.split(many, "id", 0.2, seed=s).where("is_test").collect()} for s in (1, 1, 2))
    assert a == b != c and len(a) == len(c) == 400


def test_the_rows_of_a_split_are_not_shuffled(spark):
    plan = splits.split(rows_of(spark), "id", 0.2, "label")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastNestedLoopJoin" in plan
    assert "Exchange hashpartitioning" not in plan and "Sort" not in plan


@pytest.mark.parametrize("bucket", [10_000, 50])
def test_folds_by_sorting(spark, monkeypatch, bucket):
    monkeypatch.setattr(splits, "BUCKET_ROWS", bucket)
    rows = splits.folds(rows_of(spark), "id", "label", 5).collect()
    for s in {r.label for r in rows}:
        order = sorted((r.id for r in rows if r.label == s), key=lambda i: (key(i), str(i)))
        assert {r.id: r.fold for r in rows if r.label == s} == {i: n % 5 for n, i in enumerate(order)}
        sizes = Counter(r.fold for r in rows if r.label == s)
        assert max(sizes.values()) - min(sizes[f] for f in range(5)) <= 1
    assert splits.folds(rows_of(spark).limit(0), "id", "label").count() == 0


def test_ranks_are_gapless(spark):
    df = spark.range(1000).withColumn("label", F.col("id") % 2)
    got = splits.ranks(df, "id", "label").collect()
    for s in (0, 1):
        assert sorted(r["rank"] for r in got if r.label == s) == list(range(500))
