import hashlib
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curatrix.functions.schema import align
from curatrix.operators.classify import hash_encoder
from curatrix.sources.store import ConcurrentWrite, TableStore, updated
from curatrix.streaming.embeddings import embed_in_batches
from curatrix.streaming.ingest import current, ingest


def test_store_round(spark, tmp_path):
    store = TableStore(spark, f"file://{tmp_path}/db")
    df = spark.createDataFrame([("a", 1), ("b", 2)], "id string, n int")
    assert not store.exists("t") and store.tables() == []
    store.create("t", df)
    with pytest.raises(ValueError):
        store.create("t", df)
    store.append("t", spark.createDataFrame([("c", [1, 2])], "id string, extra array<int>"))
    store.add_columns("t", {"seen": "boolean", "n": "int"})
    assert store.columns("t") == ["id", "n", "seen"]
    store.update("t", spark.createDataFrame([("a", None, True), ("z", 5, True)], "id string, n int, seen boolean"), "id", ["n", "seen"])
    store.delete("t", spark.createDataFrame([("b",), (None,)], "id string"), "id")
    assert {tuple(r) for r in store.read("t").collect()} == {("a", None, True), ("c", None, None)}
    assert store.tables() == ["t"]


def test_merge_max_keeps_the_later_date(spark):
    t = spark.createDataFrame([("a", "240101"), ("b", None), ("c", "230101")], "id string, d string")
    s = spark.createDataFrame([("a", "230505"), ("b", "230505")], "id string, d string")
    assert {tuple(r) for r in updated(t, s, "id", ["d"], ("d",)).collect()} == {("a", "240101"), ("b", "230505"), ("c", "230101")}


def test_align_serialises_nested_once(spark):
    df = spark.createDataFrame([(["a"], 1)], "x array<string>, y int")
    out = align(df, T.StructType([T.StructField("y", T.LongType()), T.StructField("x", T.StringType()), T.StructField("z", T.DoubleType())]))
    assert [tuple(r) for r in out.collect()] == [(1, '["a"]', None)]


VERSIONS = "id string, k string, publication_year int"


def arrive(spark, store, folder, *waves, **options):
    """Ingest each wave of rows as a micro-batch of its own."""
    for rows in waves:
        spark.createDataFrame(rows, VERSIONS).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(VERSIONS).parquet(f"{folder}/in")
        ingest(stream, store, "t", ["k"], ["publication_year"], f"{folder}/cp", **options).awaitTermination()
    return {(r.id, r.k) for r in current(store.read("t"), ["k"], ["publication_year"]).collect()}


def test_stream_keeps_the_latest_version(spark, tmp_path):
    store = TableStore(spark, f"file://{tmp_path}/db")
    assert arrive(spark, store, tmp_path, [("a", "x", 2000), ("b", "y", 2000)], [("c", "x", 2001), ("d", "y", 1999)]) == {("c", "x"), ("b", "y")}


def test_stream_ties_nulls_and_an_empty_wave(spark, tmp_path):
    store = TableStore(spark, f"file://{tmp_path}/db")
    waves = [[("m", "x", 2000), ("p", "x", 2000), ("n", None, 2000), ("o", "z", None)], [], [("a", "x", 2000), ("q", "z", 1)]]
    # of equally new ones the first to arrive stays, a year beats no year, rows without a key are left out
    assert arrive(spark, store, tmp_path, *waves) == {("m", "x"), ("q", "z")}


def test_a_micro_batch_appends_and_folding_is_rare(spark, tmp_path, monkeypatch):
    store = TableStore(spark, f"file://{tmp_path}/db")
    moved = []
    replace = TableStore.replace
    monkeypatch.setattr(TableStore, "replace", lambda self, name, *a, **k: moved.append(name) or replace(self, name, *a, **k))
    waves = [[(f"{n}-{i:02}", f"{i % 7}", 2000 + n) for i in range(20)] for n in range(6)]
    found = arrive(spark, store, tmp_path, *waves, fold_at=1e9)
    assert moved == ["t"]  # the creation alone
    assert store.read("t").count() == 6 * 7 and found == {(f"5-{i:02}", f"{i}") for i in range(7)}
    assert arrive(spark, store, tmp_path, [("z", "0", 3000)], fold_at=0.0) == (found - {("5-00", "0")}) | {("z", "0")}
    assert moved == ["t", "t"] and store.read("t").count() == 7 and store.sizes("t")[1] == 0


def test_a_replayed_micro_batch_changes_nothing(spark, tmp_path):
    store = TableStore(spark, f"file://{tmp_path}/db")
    waves = [[("a", "x", 2000)], [("b", "x", 2001), ("c", "y", 2001)]]
    before = arrive(spark, store, tmp_path, *waves, fold_at=1e9)
    (tmp_path / "cp" / "commits" / "1").unlink()  # as if the job had died between the append and the commit
    (tmp_path / "cp" / "commits" / ".1.crc").unlink(missing_ok=True)
    rows = store.read("t").count()
    assert arrive(spark, store, tmp_path, [], fold_at=1e9) == before and store.read("t").count() == rows
    (tmp_path / "cp" / "commits" / "1").unlink()
    (tmp_path / "cp" / "commits" / ".1.crc").unlink(missing_ok=True)
    # folded before the replay: the versions are there twice, the view shows them once
    assert arrive(spark, store, tmp_path, [], fold_at=0.0) == before


def test_an_append_with_an_id_can_be_repeated(spark, tmp_path):
    store = TableStore(spark, f"file://{tmp_path}/db")
    frame = lambda *rows: spark.createDataFrame(list(rows), "id string, n int")
    store.append_or_create("t", frame(("a", 1)), "x")
    for _ in range(2):
        store.append("t", frame(("b", 2), ("c", 3)), "y")
        store.append_or_create("t", frame(("a", 1)), "x")
    assert sorted(r.id for r in store.read("t").collect()) == ["a", "b", "c"] and store.columns("t") == ["id", "n"]
    store.append("t", frame(("b", 5)), "y")  # the batch is replaced, whatever it held
    assert sorted((r.id, r.n) for r in store.read("t").collect()) == [("a", 1), ("b", 5)]
    store.append("t", frame(("d", 4)))
    store.append("t", frame(("d", 4)))
    store.append("t", store.read("t").where("id = 'a'"), "own")  # reads what it appends to
    assert sorted(r.id for r in store.read("t").collect()) == ["a", "a", "b", "d", "d"]
    store.append("t", frame(), "empty")
    store.update("t", frame(("d", 7)), "id", ["n"])
    assert sorted(r.n for r in store.read("t").collect()) == [1, 1, 5, 7, 7]
    store.append("t", frame(("b", 6)), "y")  # ids of batches end with the version
    assert store.read("t").count() == 6


def test_an_append_that_fails_leaves_the_table(spark, tmp_path):
    store = TableStore(spark, f"file://{tmp_path}/db")
    store.create("t", spark.createDataFrame([("a", 1)], "id string, n int"))
    bad = spark.range(10).select(F.col("id").cast("string").alias("id"), F.when(F.col("id") > 7, F.raise_error(F.lit("lost"))).otherwise(1).cast("int").alias("n"))
    with pytest.raises(Exception, match="lost"):
        store.append("t", bad, "y")
    assert [r.id for r in store.read("t").collect()] == ["a"]
    store.append("t", bad.where("id < '5'"), "y")
    assert store.read("t").count() == 6


def test_two_writers_are_told_apart(spark, tmp_path):
    one, two = (TableStore(spark, f"file://{tmp_path}/db") for _ in range(2))
    df = spark.createDataFrame([("a", 1)], "id string, n int")
    one.create("t", df)

    class Slow(TableStore):
        looked = 0

        def _current(self, name):
            Slow.looked += 1
            if Slow.looked == 2:  # another writer is done while this one writes
                two.replace("t", df.withColumn("n", F.lit(2)))
            return super()._current(name)

    with pytest.raises(ConcurrentWrite):
        Slow(spark, f"file://{tmp_path}/db").replace("t", df.withColumn("n", F.lit(3)))
    assert [r.n for r in one.read("t").collect()] == [2]
    assert one.create_if_absent("t", df) is False and one.create_if_absent("u", df) is True


def test_a_killed_job_keeps_its_batches(spark, tmp_path):
    store, work = TableStore(spark, f"file://{tmp_path}/db"), f"file://{tmp_path}/work"
    rows = spark.range(50).select(F.col("id").cast("string").alias("id"), F.concat(F.lit("text "), F.col("id")).alias("text")).coalesce(1)
    flag = tmp_path / "batches"
    flag.mkdir()

    def failing():
        (flag / str(len(list(flag.iterdir())))).touch()
        if len(list(flag.iterdir())) == 3:
            raise RuntimeError("killed in batch 3")
        return hash_encoder()

    with pytest.raises(Exception, match="killed in batch 3"):
        embed_in_batches(store, "e", rows, F.col("text"), failing, work, 10)
    kept = {r.id for r in store.read("e").collect()}
    assert len(kept) == 20
    assert embed_in_batches(store, "e", rows, F.col("text"), hash_encoder, work, 10) == 3
    found = [r.id for r in store.read("e").collect()]
    assert len(found) == len(set(found)) == 50 and kept <= set(found)
    assert embed_in_batches(store, "e", rows, F.col("text"), hash_encoder, work, 10) == 0
    more = rows.unionByName(spark.createDataFrame([("new", "x"), (None, None)], "id string, text string"))
    assert embed_in_batches(store, "e", more, F.col("text"), hash_encoder, work, 10, run="1") >= 1
    assert store.read("e").where("id = 'new'").count() == 1


def test_a_batch_of_embeddings_is_shared_out_among_tasks(spark, tmp_path):
    store, work = TableStore(spark, f"file://{tmp_path}/db"), f"file://{tmp_path}/work"
    tasks = tmp_path / "tasks"
    tasks.mkdir()

    def counting():
        (tasks / uuid.uuid4().hex).touch()
        return hash_encoder()

    rows = spark.range(9000).select(F.col("id").cast("string").alias("id"), F.concat(F.lit("text "), F.col("id")).alias("text")).coalesce(1)
    batches = embed_in_batches(store, "e", rows, F.col("text"), counting, work, 4000)
    assert batches == 3 and len(list(tasks.iterdir())) > batches
    found = [r.id for r in store.read("e").collect()]
    assert len(found) == len(set(found)) == 9000


def test_hash_encoder_by_its_definition():
    texts = ["", "Aa b aa  É", "x " * 300 + "y"]
    expected = np.zeros((3, 8), np.float32)
    for i, t in enumerate(texts):
        for w in t.lower().split():
            h = int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little")
            expected[i, h % 8] += 1.0 if h >> 63 else -1.0
    norms = np.linalg.norm(expected, axis=1, keepdims=True)
    encode = hash_encoder(8)
    assert (encode(texts) == expected / np.where(norms == 0, 1, norms)).all() and (encode(texts) == encode(texts)).all()
