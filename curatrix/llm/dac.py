"""Operator 2, token-id output: files of directly addressable codes.

An id is cut into 8-bit chunks, lowest first.  Level k holds the k-th chunks of those ids that have
so many; a continuation bitmap beside each level tells which ids go on, and a rank directory (ones
before every 512 bits) gives the place of an id's next chunk.  Any token is found by one byte and
one rank per level; no block is decoded.

A segment is, little-endian::

    magic "DAC1" | u32 levels | u64 docs | u64 tokens
    i64 doc ids | u8 doc id is null | u64 first token of each document, and the end
    per level: u64 chunks | chunks, a byte each | bitmap, padded to 64 bytes | u32 ones before each 512 bits

A file is segments, each behind its length (u64) and in front of one newline byte; that byte lets
Spark's own text writer, with its commit protocol, put binary files on any file system, and
``binaryFile`` read them.  Files follow one another in name order, documents in ascending id order.
Ranges of ids are found on the ids alone, texts are encoded where they are read, and only ids are
shuffled, two bytes each where the vocabulary allows it.

Defined results: null text is the empty text (only the end id); null doc_id sorts first; rows with
equal doc_id are ordered by the checksum of their ids; other columns of the input are ignored; an empty
table gives no documents.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import encoder, encoder_size
from .common import batches, crc_u32, scratch, shuffle_partitions, stored, text_list

MAGIC = b"DAC1"
CHUNK_BITS = 8
BLOCK_BITS = 512
#: A segment is closed at this many tokens, which bounds a task's memory; a file holds so many segments.
SEGMENT_TOKENS = 1 << 20
FILE_SEGMENTS = 64


def pack_segment(doc_ids: list[int | None], ids: list[np.ndarray]) -> bytes:
    """One segment of the file format from documents' id arrays."""
    counts = np.fromiter((len(x) for x in ids), np.int64, len(ids))
    starts = np.zeros(len(ids) + 1, "<u8")
    np.cumsum(counts, out=starts[1:])
    left = np.concatenate(ids).astype("<u4", copy=False) if ids else np.zeros(0, "<u4")
    total, levels = len(left), []
    while True:
        go_on = left >= (1 << CHUNK_BITS)
        bits = np.packbits(go_on, bitorder="little")
        bits = np.concatenate([bits, np.zeros(-len(bits) % (BLOCK_BITS // 8), np.uint8)])
        ones = np.bitwise_count(bits.reshape(-1, BLOCK_BITS // 8)).sum(axis=1)
        rank = np.zeros(len(ones) + 1, "<u4")
        np.cumsum(ones, out=rank[1:])
        levels.append(struct.pack("<Q", len(left)) + (left & 0xFF).astype(np.uint8).tobytes() + bits.tobytes() + rank.tobytes())
        if not go_on.any():
            break
        left = left[go_on] >> CHUNK_BITS
    head = MAGIC + struct.pack("<IQQ", len(levels), len(ids), total)
    keys = np.fromiter((0 if x is None else x for x in doc_ids), "<i8", len(ids))
    nulls = np.fromiter((x is None for x in doc_ids), np.uint8, len(ids))
    return b"".join([head, keys.tobytes(), nulls.tobytes(), starts.tobytes(), *levels])


class Segment:
    """A view of one segment's bytes (or a memory map of them)."""

    def __init__(self, data: bytes | memoryview):
        view = memoryview(data)
        if bytes(view[:4]) != MAGIC:
            raise ValueError("no segment of directly addressable codes")
        n_levels, self.n_docs, self.n_tokens = struct.unpack_from("<IQQ", view, 4)
        at = 24

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(view, kind, n, at)
            at += out.nbytes
            return out

        self.doc_ids, self.null_ids, self.starts = take("<i8", self.n_docs), take("u1", self.n_docs), take("<u8", self.n_docs + 1)
        self.levels = []
        for _ in range(n_levels):
            n = int(take("<u8", 1)[0])
            blocks = -(-n // BLOCK_BITS)
            self.levels.append((take("u1", n), take("u1", blocks * BLOCK_BITS // 8), take("<u4", blocks + 1)))

    def token(self, i: int) -> int:
        """The id of token ``i``: a byte and a rank for each of its chunks."""
        if not 0 <= i < self.n_tokens:
            raise IndexError(i)
        value = 0
        for k, (chunks, bits, rank) in enumerate(self.levels):
            value |= int(chunks[i]) << (CHUNK_BITS * k)
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            block = i // BLOCK_BITS
            lo = block * BLOCK_BITS // 8
            inside = int(np.bitwise_count(bits[lo : i >> 3]).sum()) + (int(bits[i >> 3]) & ((1 << (i & 7)) - 1)).bit_count()
            i = int(rank[block]) + inside
        return value

    def document(self, d: int) -> np.ndarray:
        """The ids of the d-th document of the segment."""
        return self.tokens(int(self.starts[d]), int(self.starts[d + 1]))

    def tokens(self, lo: int, hi: int) -> np.ndarray:
        """Ids of tokens lo to hi: on each level only the chunks of this range are touched."""
        out = np.zeros(hi - lo, "<u4")
        where = np.arange(hi - lo)
        for k, (chunks, bits, rank) in enumerate(self.levels):
            if lo == hi:
                break
            out[where] |= chunks[lo:hi].astype("<u4") << (CHUNK_BITS * k)
            byte = lo >> 3
            go_on = np.unpackbits(bits[byte : -(-hi // 8)], bitorder="little")[lo - 8 * byte : hi - 8 * byte].astype(bool)
            block = lo // BLOCK_BITS
            inside = int(np.unpackbits(bits[block * BLOCK_BITS // 8 : byte + 1], bitorder="little")[: lo - block * BLOCK_BITS].sum())
            lo = int(rank[block]) + inside
            hi = lo + int(go_on.sum())
            where = where[go_on]
        return out


def read_segments(content: bytes | memoryview) -> Iterator[Segment]:
    """The segments of one file's bytes."""
    view, at = memoryview(content), 0
    while at < len(view):
        (n,) = struct.unpack_from("<Q", view, at)
        yield Segment(view[at + 8 : at + 8 + n])
        at += 8 + n + 1


def write_token_files(docs: DataFrame, path: str, vocabulary: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode whole texts, end each with ``end_id``, write the files to ``path`` in ascending id order."""

    rows = docs.select(F.col(id_col).cast("long").alias("key"), F.col(text_col).alias("text"))
    wide = encoder_size(vocabulary) > 1 << 16 or end_id >= 1 << 16
    parts = shuffle_partitions(docs.sparkSession)
    # ranges of ids by a pass over the ids alone; ranges for null ids are as many as their share asks for
    cuts = [i / parts for i in range(1, parts)] or [0.5]
    seen = rows.agg(F.count("*").alias("n"), F.count("key").alias("some"), F.percentile_approx("key", cuts, max(10_000, 20 * parts)).alias("cuts")).first()
    spare = -(-parts * (seen["n"] - seen["some"]) // max(1, seen["n"]))
    bounds = np.array(seen["cuts"] or [], np.int64)

    def encode(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(vocabulary), np.array([end_id], "<u4").tobytes()
        for batch in batches(it, 500, 2 << 20):
            keys, found, at, crcs = batch.column(0), [], [], []
            lows = np.searchsorted(bounds, keys.fill_null(0).to_numpy(), "left") + spare
            highs = np.searchsorted(bounds, keys.fill_null(0).to_numpy(), "right") + spare
            for raw, lo, hi, null in zip(enc.encode(text_list(batch.column(1))), lows.tolist(), highs.tolist(), keys.is_null().to_pylist(), strict=True):
                ids = np.frombuffer(raw + end, "<u4")
                crc = crc_u32(ids)
                lo, hi = (0, max(0, spare - 1)) if null else (lo, hi)
                at.append(lo + (crc * (hi - lo + 1) >> 32))  # an id that fills several ranges is spread in the order of checksums
                crcs.append(crc)
                found.append(raw + end if wide else ids.astype("<u2").tobytes())
            yield pa.RecordBatch.from_arrays([keys, pa.array(at, pa.int32()), pa.array(crcs, pa.int64()), pa.array(found, pa.binary())], ["key", "at", "crc", "ids"])

    def segments(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list = []
        held: list[np.ndarray] = []
        n = 0

        def flush() -> pa.RecordBatch:
            body = pack_segment(keys, held)
            return pa.RecordBatch.from_arrays([pa.array([struct.pack("<Q", len(body)) + body], pa.binary())], ["segment"])

        for batch in batches(it, 500, 2 << 20):
            for key, raw in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                keys.append(key)
                held.append(np.frombuffer(raw, "<u4" if wide else "<u2"))
                n += len(held[-1])
                if n >= SEGMENT_TOKENS:
                    yield flush()
                    keys, held, n = [], [], 0
        if keys:
            yield flush()

    encoded = rows.mapInArrow(encode, "key long, at int, crc long, ids binary")
    order = [F.col("key").asc_nulls_first(), F.col("crc").asc()]
    packed = encoded.repartitionById(parts + spare + 1, F.col("at")).sortWithinPartitions(*order).mapInArrow(segments, "segment binary")
    packed.select(F.col("segment").cast("string").alias("value")).write.option("maxRecordsPerFile", FILE_SEGMENTS).text(path)


def read_token_files(spark, path: str) -> DataFrame:
    """Documents of token files, in file order: ``file``, ``place``, doc_id, file_start, n_tokens, ids_crc32."""

    def decode(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it, 1):
            part, more = re.search(r"part-(\d+).*?(?:-c(\d+))?\.[^/]*$", batch.column(0)[0].as_py()).groups()
            file = int(part) << 24 | int(more or 0)
            start = place = 0
            for seg in read_segments(batch.column(1)[0].as_buffer()):
                ids, bounds = seg.tokens(0, seg.n_tokens), seg.starts.astype(np.int64)
                n = seg.n_docs
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, file, np.int64)),
                        pa.array(np.arange(place, place + n, dtype=np.int64)),
                        pa.array(seg.doc_ids.astype(np.int64), mask=seg.null_ids.astype(bool)),
                        pa.array(start + bounds[:-1]),
                        pa.array(np.diff(bounds)),
                        pa.array([crc_u32(ids[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.int64()),
                    ],
                    ["file", "place", "doc_id", "file_start", "n_tokens", "ids_crc32"],
                )
                start += seg.n_tokens
                place += n

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(decode, "file long, place long, doc_id long, file_start long, n_tokens long, ids_crc32 long")


def token_output(docs: DataFrame, vocabulary: str, end_id: int = 0, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write ``docs`` as token files and return what the files hold: a row for each document.

    ``start`` counts the ids of all documents before it.  The table of files' sizes that turns
    places in a file into places in the whole has a row for each file.
    """
    spark = docs.sparkSession
    path = path or scratch(spark, "tokens")
    write_token_files(docs, path, vocabulary, end_id, id_col, text_col)
    found = stored(read_token_files(spark, path), "token-index")
    sizes = sorted((r["file"], r["n"]) for r in found.groupBy("file").agg(F.sum("n_tokens").alias("n")).collect())
    before, n = [], 0
    for file, size in sizes:
        before.append((file, n))
        n += size
    bases = spark.createDataFrame(before, "file long, base long")
    return found.join(F.broadcast(bases), "file").select("doc_id", (F.col("base") + F.col("file_start")).alias("start"), "n_tokens", "ids_crc32", "file", "place")
