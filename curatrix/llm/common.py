"""Helpers shared by the operators: shared storage, lineage cuts, gapless numbering."""

from __future__ import annotations

import atexit
import ctypes
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHECKPOINT_CONF = "spark.checkpoint.dir"
_own_dir: str | None = None


#: Rows of the Arrow batches between Spark and Python, where the session has no bound of its own; texts may be long.
ARROW_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(bound) == "10000":  # Spark's default
        spark.conf.set(bound, str(ARROW_ROWS))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    The cluster names it in ``spark.checkpoint.dir``.  Only where that is unset (local tests, one
    machine) a temporary folder is made, and removed at exit.
    """
    global _own_dir
    named = spark.conf.get(CHECKPOINT_CONF, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError(f"{CHECKPOINT_CONF} has to name a folder that driver and executors share")
    if _own_dir is None:
        _own_dir = tempfile.mkdtemp(prefix="curatrix-")
        atexit.register(shutil.rmtree, _own_dir, ignore_errors=True)
    return f"file://{_own_dir}"


def scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage of ``df``: write it as Parquet to the shared folder and read it back.

    Lost executors then cost a reread and no recomputation, and what non-deterministic partitioning
    decided stays decided.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def numbered(df: DataFrame, order: list[str], group: str | None = None, name: str = "numbered") -> DataFrame:
    """Add ``_index``: a gapless number from 0 in the order of ``order``, within ``group`` if given.

    Range partitions (balanced by sampling, so a hot group is spread over many) number their own
    rows and are written once; the first numbers of each partition and group come from a small
    table of counts, a row for each range.  No task holds a whole group.  ``order`` has to decide
    the order; equal rows are numbered arbitrarily, but once and for all.  Nulls first.
    """
    spark = df.sparkSession
    keys = [F.col(k).asc_nulls_first() for k in ([group] if group else []) + order]

    def number(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, n = TaskContext.get().partitionId(), None, 0
        for batch in it:
            local = np.empty(batch.num_rows, np.int64)
            for i, g in enumerate(batch.column(group).to_pylist() if group else [None] * batch.num_rows):
                if g != last:
                    last, n = g, 0
                local[i] = n
                n += 1
            parts = pa.array(np.full(batch.num_rows, part, np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, parts, pa.array(local)], [*batch.schema.names, "_part", "_local"])

    schema = T.StructType([*df.schema.fields, T.StructField("_part", T.IntegerType()), T.StructField("_local", T.LongType())])
    parted = stored(df.repartitionByRange(shuffle_partitions(spark), *keys).sortWithinPartitions(*keys).mapInArrow(number, schema), name)
    by = ["_part", group] if group else ["_part"]
    seen: dict = {}
    rows = []
    for r in sorted(parted.groupBy(*by).agg(F.max("_local").alias("n")).collect(), key=lambda r: r["_part"]):
        g = r[group] if group else None
        rows.append((r["_part"], g, seen.get(g, 0)))
        seen[g] = seen.get(g, 0) + r["n"] + 1
    kind = df.schema[group].dataType if group else T.IntegerType()
    offsets = spark.createDataFrame(rows, T.StructType([T.StructField("_p", T.IntegerType()), T.StructField("_g", kind), T.StructField("_offset", T.LongType())]))
    same = (F.col("_part") == F.col("_p")) & (F.col(group).eqNullSafe(F.col("_g")) if group else F.lit(True))
    # a row for each range partition and the groups that meet there
    return parted.join(F.broadcast(offsets), same).withColumn("_index", F.col("_local") + F.col("_offset")).drop("_part", "_local", "_p", "_g", "_offset")


def release() -> None:
    """Give freed memory back to the system: workers are kept, and so is what their allocators hold."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def batches(it: Iterator[pa.RecordBatch], size: int = 500, most_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Re-slice record batches to at most ``size`` rows and so many bytes (or one row)."""
    try:
        yield from _slices(it, size, most_bytes)
    finally:
        release()


def _slices(it: Iterator[pa.RecordBatch], size: int, most_bytes: int) -> Iterator[pa.RecordBatch]:
    for batch in it:
        parts = [(0, batch.num_rows)] if batch.num_rows else []
        while parts:
            lo, hi = parts.pop()
            part = batch.slice(lo, hi - lo)
            if hi - lo > 1 and (hi - lo > size or part.nbytes > most_bytes):
                mid = lo + min(size, (hi - lo) // 2) if hi - lo > size else (lo + hi) // 2
                parts += [(mid, hi), (lo, mid)]
            else:
                yield part


def text_list(column: pa.Array) -> list[str]:
    """Texts as Python strings; null counts as empty."""
    return [x or "" for x in column.to_pylist()]


def crc_u32(ids: np.ndarray) -> int:
    import zlib

    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4"))
