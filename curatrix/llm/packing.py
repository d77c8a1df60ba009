"""Operator 8, best-fit packing by large-item matching, over a histogram of lengths.

Pieces of equal length are interchangeable, so the packing itself is decided on how many pieces
there are of each length: at most ``capacity`` counters, whatever the corpus.  Pieces longer than a
third of the capacity go at most twice into a sequence and are matched greedily, the longest with
the longest partner that still fits; shorter ones, longest first, go into the smallest gap that
takes them.  The result is a list of runs "the next n pieces of this length stand at this offset in
sequences s, s + 1, ..."; every piece finds its own place from its rank among pieces of its length.
Ranks come from counts per partition and length, so no task ever holds all pieces.

Defined results: null text is the empty text (a document of one end id); documents with equal ids or
null id keep a row for each piece; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import MEMO_WORDS, encoder
from .common import batches, crc_u32, stored, text_list

PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long"


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, n pieces, sequence of the first, offset).

    Each run puts n pieces of one length at one offset of n consecutive sequences.
    """
    left = {s: n for s, n in histogram.items() if n > 0}
    if any(not 0 < s <= capacity for s in left):
        raise ValueError("a length is outside 1 to the capacity")
    used: dict[int, int] = dict.fromkeys(left, 0)
    runs: list[tuple[int, int, int, int, int]] = []
    bins: dict[int, list[tuple[int, int]]] = {}  # gap -> ranges of sequences (first, count)
    gaps: list[int] = []
    opened = 0

    def add(gap: int, first: int, count: int) -> None:
        if gap not in bins:
            bins[gap] = []
            insort(gaps, gap)
        bins[gap].append((first, count))

    def put(size: int, first: int, count: int, offset: int) -> None:
        runs.append((size, used[size], count, first, offset))
        used[size] += count
        left[size] -= count

    # Pieces above a third of the capacity, longest first: the longest partner that fits, if any.
    large = sorted(s for s in left if 3 * s > capacity)
    while large:
        a = large[-1]
        i = bisect_left(large, capacity - a + 1) - 1
        b = large[i] if i >= 0 else None
        if b is None:
            n = left[a]
            put(a, opened, n, 0)
            add(capacity - a, opened, n)
        elif b == a:
            n = left[a] // 2
            if n:
                put(a, opened, n, 0)
                put(a, opened, n, a)
                add(capacity - 2 * a, opened, n)
            elif i > 0:  # one piece of this length is left: the next shorter one is its partner
                b, n = large[i - 1], 1
                put(a, opened, 1, 0)
                put(b, opened, 1, a)
                add(capacity - a - b, opened, 1)
            else:
                n = 1
                put(a, opened, 1, 0)
                add(capacity - a, opened, 1)
        else:
            n = min(left[a], left[b])
            put(a, opened, n, 0)
            put(b, opened, n, a)
            add(capacity - a - b, opened, n)
        opened += n
        large = [s for s in large if left[s]]

    # The rest, longest first, each into the smallest gap that takes it.
    for size in sorted((s for s in left if left[s]), reverse=True):
        while left[size]:
            i = bisect_left(gaps, size)
            if i == len(gaps):
                n = -(-left[size] // (capacity // size))
                add(capacity, opened, n)
                opened += n
                continue
            gap = gaps[i]
            first, count = bins[gap].pop()
            each = min(gap // size, left[size])  # a sequence is filled before the next is begun
            n = min(count, left[size] // each)
            for k in range(each):
                put(size, first, n, capacity - gap + k * size)
            if n < count:
                bins[gap].append((first + n, count - n))
            if not bins[gap]:
                del bins[gap]
                gaps.pop(i)
            if gap > each * size:
                add(gap - each * size, first, n)
    return runs


def token_pieces(docs: DataFrame, vocabulary: str, end_id: int, capacity: int, id_col: str = "doc_id", text_col: str = "text", memo_words: int = MEMO_WORDS) -> DataFrame:
    """Documents as pieces of at most ``capacity`` ids; only longer ones are cut, the first piece takes the rest."""

    def cut(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(vocabulary, memo_words), np.array([end_id], "<u4").tobytes()
        for batch in batches(it, 500, 2 << 20):
            out: list[list] = [[], [], [], [], []]
            for key, raw in zip(batch.column(0).to_pylist(), enc.encode(text_list(batch.column(1))), strict=True):
                ids = np.frombuffer(raw + end, "<u4")
                n = -(-len(ids) // capacity)
                bounds = [0, *range(len(ids) - (n - 1) * capacity, len(ids) + 1, capacity)]
                for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
                    for column, x in zip(out, (key, k, a, b - a, crc_u32(ids[a:b])), strict=True):
                        column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64()), strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(cut, PIECES)


def pack(pieces: DataFrame, capacity: int, length_col: str = "length") -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows that have a length of 1 to ``capacity``."""
    spark = pieces.sparkSession
    pieces = stored(pieces.withColumn("_part", F.spark_partition_id()), "pieces")
    counts = pieces.groupBy("_part", length_col).agg(F.count("*").alias("_n"))
    # Pieces of this length in earlier partitions: a window over counts, not over pieces.
    before = Window.partitionBy(length_col).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = stored(counts.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0))), "piece-counts")
    histogram = {r[length_col]: r["n"] for r in bases.groupBy(length_col).agg(F.sum("_n").alias("n")).collect()}  # at most capacity rows
    runs = plan(histogram, capacity)
    by_length: dict[int, list[tuple[int, int, int]]] = {}
    for size, rank, _, sequence, offset in runs:
        by_length.setdefault(size, []).append((rank, sequence, offset))
    tables = {size: tuple(np.array(x, np.int64) for x in zip(*sorted(rows), strict=True)) for size, rows in by_length.items()}
    shared = spark.sparkContext.broadcast(tables)  # bounded by the capacity, not by the corpus

    extra = [c for c in pieces.columns if c not in ("_part", length_col)]
    local = Window.partitionBy("_part", length_col).orderBy(*[c for c in ("doc_id", "piece") if c in extra])
    ranked = (
        pieces.withColumn("_local", F.row_number().over(local) - 1)
        .join(bases.select("_part", length_col, "_base"), ["_part", length_col])
        .select(*extra, length_col, (F.col("_local") + F.col("_base")).cast("long").alias("_rank"))
    )

    def place(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = shared.value
        for batch in it:
            size, rank = batch.column(length_col).to_numpy(), batch.column("_rank").to_numpy()
            sequence, offset = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
            order = np.argsort(size, kind="stable")
            edges = np.flatnonzero(np.diff(size[order], prepend=-1))
            for lo, hi in zip(edges, [*edges[1:], len(order)], strict=True):
                rows = order[lo:hi]
                first, seq, off = at[int(size[rows[0]])]
                i = np.searchsorted(first, rank[rows], side="right") - 1
                sequence[rows] = seq[i] + rank[rows] - first[i]
                offset[rows] = off[i]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in (*extra, length_col)], pa.array(sequence), pa.array(offset)], [*extra, length_col, "sequence_id", "offset"])

    kinds = {f.name: f.dataType.simpleString() for f in pieces.schema}
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in (*extra, length_col)) + ", sequence_id long, offset long"
    return ranked.mapInArrow(place, schema)


def pack_documents(docs: DataFrame, vocabulary: str, end_id: int = 2, capacity: int = 1024, memo_words: int = MEMO_WORDS) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens; a row for each piece."""
    packed = pack(token_pieces(docs, vocabulary, end_id, capacity, memo_words=memo_words), capacity)
    return packed.select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", "offset")
