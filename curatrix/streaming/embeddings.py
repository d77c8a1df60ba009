"""Embeddings with a checkpoint after every batch: a failed job keeps the batches before it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.classify import Encoder, embed
from ..operators.curate import unseen
from ..sources.store import TableStore

#: Rows of a batch that are worth a task of their own.
FILE_ROWS = 1000


def embed_in_batches(store: TableStore, table: str, rows: DataFrame, text: Column, load: Callable[[], Encoder], work: str, batch_rows: int = 100_000, run: str = "0") -> int:
    """Add (id, embeddings) of the rows that ``table`` does not have; how many batches this call has made.

    What is to do is written once under ``work``, in files that share out ``batch_rows`` rows among the cores; a stream takes
    so many files at a time until none is left, and each of its micro-batches is an append with its own id.  A call with
    the same ``work`` and ``run`` goes on behind the last batch that was committed; a batch that failed halfway is made
    again and replaces what it left.  A new ``run`` starts from the rows that are missing then.
    """
    spark = store.spark
    store.create_if_absent(table, spark.createDataFrame([], "id string, embeddings array<float>"))
    todo = TableStore(spark, f"{work}/{run}")
    files = max(1, min(spark.sparkContext.defaultParallelism, batch_rows // FILE_ROWS))
    if not todo.exists("todo"):
        missing = unseen(rows, store.read(table)).select(F.col("id").cast("string").alias("id"), text.alias("text"))
        # the table is written whole before its pointer is; a crash before that starts over
        todo.replace("todo", missing, per_file=batch_rows // files)
    stream = spark.readStream.schema("id string, text string").option("maxFilesPerTrigger", files).option("recursiveFileLookup", "true").parquet(todo.location("todo"))
    made = 0

    def step(batch: DataFrame, number: int) -> None:
        nonlocal made
        store.append(table, embed(batch, F.col("text"), load).select("id", "embeddings"), f"embed-{run}-{number}")
        made += 1

    stream.writeStream.foreachBatch(step).option("checkpointLocation", f"{work}/{run}/progress").trigger(availableNow=True).start().awaitTermination()
    return made
