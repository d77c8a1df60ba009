"""Operator 4, sharding by Karmarkar-Karp differencing of indivisible groups.

Law ``bytes``: the shards' sizes are as equal as differencing makes them, and rows of one text stay
together.  A group of equal texts is one number, its bytes.  Differencing keeps partial partitions
(k sums each) and again and again combines the two with the largest spread, oppositely ordered.  As
what it combines are partial partitions, it works in two levels: each hash partition differences its
own groups down to one partial partition, then those (k sums for each hash partition) are
differenced on the driver, which settles which part of which partition goes to which shard.

Groups above a five-hundredth of all rows (fewer than 500 of them) reach their rows by a broadcast,
the others by a shuffle; slots are numbered by ranges.  A group larger than a fair share fills its
shard alone; nothing can make that more even.

Defined results: null text has size 8 and the checksum of no bytes, and null texts are one group;
repeated rows and null ids are kept, each with a slot of its own; slots follow doc_id; other columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import numbered, stored

#: Groups with more than 1 / HOT_SHARE of all rows are joined by broadcast.
HOT_SHARE = 500


def difference(partials: list[list[int]], k: int) -> list[list[int]]:
    """Karmarkar-Karp over partial partitions of k sums.

    Gives, for every partial partition, the final part of each of its k sums.
    """
    if not partials:
        return []
    heap = []
    children: list[tuple | None] = [None] * len(partials)  # of a combined part order: (left, its order), (right, its order)
    for i, sums in enumerate(partials):
        order = sorted(range(k), key=lambda j: (-sums[j], j))
        ranked = [sums[j] for j in order]
        children[i] = ("leaf", order)
        heap.append((ranked[-1] - ranked[0], i, [x - ranked[-1] for x in ranked]))  # smallest first: minus the spread
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a, left = heapq.heappop(heap)
        _, b, right = heapq.heappop(heap)
        sums = [x + y for x, y in zip(left, reversed(right), strict=True)]
        order = sorted(range(k), key=lambda j: -sums[j])
        low = sums[order[-1]]
        # only differences decide: the common part of the sums is left out to keep numbers small
        ranked = [sums[j] - low for j in order]
        children.append(("both", a, b, order))
        heapq.heappush(heap, (-ranked[0], len(children) - 1, ranked))
    out: list[list[int]] = [[] for _ in partials]
    stack = [(heap[0][1], list(range(k)))]  # node, final part of each of its ranked sums
    while stack:
        node, final = stack.pop()
        entry = children[node]
        if entry[0] == "leaf":
            parts = [0] * k
            for rank, j in enumerate(entry[1]):
                parts[j] = final[rank]
            out[node] = parts
        else:
            _, a, b, order = entry
            at = [0] * k
            for rank, j in enumerate(order):
                at[j] = final[rank]
            stack += [(a, at), (b, at[::-1])]
    return out


def assign_groups(groups: DataFrame, shards: int) -> DataFrame:
    """``group``, ``n`` and ``bytes`` of each group, with its ``shard``."""

    def local(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(it)
        if not held:
            return
        batch = pa.Table.from_batches(held)
        order = np.argsort(batch["group"].to_numpy(), kind="stable")  # the same parts however the rows arrive
        sizes = batch["bytes"].to_numpy()[order]
        parts = [p[0] for p in difference([[int(s)] + [0] * (shards - 1) for s in sizes], shards)]
        table = batch.take(pa.array(order))
        bucket = pa.array(np.full(len(order), TaskContext.get().partitionId(), np.int32))
        for name, column in (("bucket", bucket), ("part", pa.array(parts, pa.int32()))):
            table = table.append_column(name, column)
        yield from table.to_batches(max_chunksize=50_000)

    found = stored(groups.select("group", "n", "bytes").mapInArrow(local, "group long, n long, bytes long, bucket int, part int"), "shard-parts")
    sums: dict[int, list[int]] = {}
    for r in found.groupBy("bucket", "part").agg(F.sum("bytes").alias("bytes")).collect():  # shards x hash partitions
        sums.setdefault(r["bucket"], [0] * shards)[r["part"]] = r["bytes"]
    buckets = sorted(sums)
    final = difference([sums[b] for b in buckets], shards)
    spark = groups.sparkSession
    mapping = spark.createDataFrame([(b, j, parts[j]) for b, parts in zip(buckets, final, strict=True) for j in range(shards)], "bucket int, part int, shard int")
    return found.join(F.broadcast(mapping), ["bucket", "part"]).select("group", "n", "bytes", "shard")  # shards x hash partitions


def shard_documents(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each document: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    text = F.col(text_col)
    rows = stored(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
            F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
            F.xxhash64(text).alias("group"),
        ),
        "shard-rows",
    )
    groups = stored(assign_groups(rows.groupBy("group").agg(F.count("*").alias("n"), F.sum("size").alias("bytes")), shards), "shard-groups")
    total = rows.count()
    is_hot = F.col("n") * HOT_SHARE > total
    hot = groups.where(is_hot).select("group", "shard")  # fewer than HOT_SHARE rows
    cold = groups.where(~is_hot).select("group", "shard")
    keys = [r["group"] for r in hot.select("group").collect()]
    marked = F.col("group").isin(keys) if keys else F.lit(False)
    placed = rows.where(marked).join(F.broadcast(hot), "group").unionByName(rows.where(~marked).join(cold, "group"))
    slots = numbered(placed.select("doc_id", "size", "text_crc32", "shard"), ["doc_id"], "shard", "shard-slots")
    return slots.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("_index").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
