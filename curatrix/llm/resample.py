"""Operator 11, importance resampling towards a target distribution, over an integer word dictionary.

Documents are read in blocks of bounded size.  Within a block every distinct word gets a number and a
document becomes the numbers of its n-grams, so a block is written once, as integers, with the list of
its distinct words and their counts.  Those lists, and not the texts, are brought together: each
distinct word of the corpus gets a dictionary id, an n-gram is a tuple of these ids, and each distinct
tuple's bytes are put together and hashed once.  For one word the tuple is its dictionary row; a longer
tuple is spelled in one of the blocks that hold it.  Counts of the hash buckets are then summed, and
the buckets are joined back: first to each block's words and tuples, then, in the block, to documents.

A bucket's gain is ``floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B))))`` for s of the corpus' S features and t of
the target's T in it, with B buckets.  A document's weight is the floored mean gain of its features, its score that
plus ``floor(-1000 ln(-ln u))`` with u from a hash of its id: the highest scores are a sample without
replacement, in proportion to the exponential of the weight.  Of documents with enough words the given
percentage with the highest scores is drawn, ties to the smaller id.

Shuffled are the distinct words of each block (not its words), and each block's documents as integers.
No group is larger than a block; a word has at most one row for each block.  What reaches the driver
is a count a bucket, and a count for each distinct score, of which there are at most some ten thousand
times the logarithm of the number of words.  Ranks come from range partitions of the drawn documents, which no task holds whole.

Defined results: a null or empty text has no words, weight 0, and is not drawn (unless ``least_words`` is
0); a null id is hashed as an empty one and goes first among ties; repeated rows are drawn one by one;
equal scores go by id, and equal ids in any order; other columns are ignored; very long texts are read
whole, one of them may be larger than a block; with an empty target all gains follow from t = 0; an
empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batches, numbered, stored

#: Bytes of text of a block; a block ends with the document that reaches it.
BLOCK_BYTES = 16 << 20
#: Bytes of a text that are split at a time.
PIECE = 1 << 20

_TABLE = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))

COLUMNS = ["block", "no", "doc_id", "n_words", "grams", "word", "parts", "n"]
BLOCKS = "block long, no long, doc_id long, n_words long, grams binary, word string, parts array<int>, n long"
KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string(), pa.list_(pa.int32()), pa.int64()]


def split_words(text: bytes) -> Iterator[list[bytes]]:
    """Words of a UTF-8 text, A-Z in lower case, a bounded part of the text at a time."""
    text = text.translate(_TABLE)
    at = 0
    while at < len(text):
        end = len(text) if len(text) - at <= PIECE else text.rfind(b" ", at, at + PIECE)
        if end <= at:  # a word longer than that
            end = text.find(b" ", at + PIECE)
            end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end + 1


def packed(numbers: np.ndarray) -> bytes:
    """Numbers in ascending order (theirs does not matter here), as differences, all first bytes, all second ones ...: most are zero."""
    return np.diff(np.sort(numbers), prepend=np.int32(0)).astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<i4").ravel().cumsum()


def record(size: int, **columns: pa.Array) -> pa.RecordBatch:
    """Rows of ``BLOCKS``, null where no column is given."""
    return pa.RecordBatch.from_arrays([columns[c] if c in columns else pa.nulls(size, k) for c, k in zip(COLUMNS, KINDS, strict=True)], COLUMNS)


class Block:
    """Some documents as numbers: of distinct words, and of distinct tuples of two words or more."""

    def __init__(self, low: int, high: int):
        self.low, self.high = low, high
        # a tuple of order k is the number of its first k - 1 words' tuple and that of its last word
        self.known: list[dict] = []
        for _ in range(high):
            d: dict = defaultdict()
            d.default_factory = d.__len__
            self.known.append(d)
        self.size = 0
        self.rows: list[tuple[int | None, list[np.ndarray]]] = []

    def add(self, doc_id: int | None, text: bytes) -> None:
        number = self.known[0].__getitem__
        parts = [np.fromiter(map(number, words), np.int32, len(words)) for words in split_words(text)]
        words = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        grams = [words]
        for k, known in enumerate(self.known[1:], 1):
            pairs = grams[-1][: max(0, len(words) - k)].astype(np.int64) << 32 | words[k:]
            grams.append(np.fromiter(map(known.__getitem__, pairs.tolist()), np.int32, len(pairs)))
        self.rows.append((doc_id, grams))
        self.size += len(text)

    def emit(self, block: int) -> Iterator[pa.RecordBatch]:
        """A row for each document, word, and longer tuple (from order ``low``); words and tuples are numbered through."""
        first = np.cumsum([0, *map(len, self.known)])
        counts = np.zeros(first[-1], np.int64)
        for lo in range(0, len(self.rows), 1000):
            part = self.rows[lo : lo + 1000]
            grams = [np.concatenate([g + np.int32(f) for g, f in zip(g[self.low - 1 :], first[self.low - 1 :], strict=False)]) for _, g in part]
            counts += np.bincount(np.concatenate(grams), minlength=len(counts))
            yield record(
                len(part),
                block=pa.array(np.full(len(part), block)),
                doc_id=pa.array([i for i, _ in part], pa.int64()),
                n_words=pa.array([len(g[0]) for _, g in part], pa.int64()),
                grams=pa.array(list(map(packed, grams)), pa.binary()),
            )
        spelled = np.arange(first[1], dtype=np.int32)[:, None]
        for k, known in enumerate(self.known):
            if k:
                pairs = np.fromiter(known, np.int64, len(known))
                spelled = np.concatenate([spelled[pairs >> 32], (pairs & 0xFFFFFFFF).astype(np.int32)[:, None]], axis=1)
            names = list(known) if not k else None
            for lo in range(0, len(known) if not k or k + 1 >= self.low else 0, 20_000):
                hi = min(len(known), lo + 20_000)
                own = {"block": pa.array(np.full(hi - lo, block)), "no": pa.array(np.arange(lo, hi) + first[k]), "n": pa.array(counts[first[k] + lo : first[k] + hi])}
                if k:
                    own["parts"] = pa.ListArray.from_arrays(pa.array(np.arange(hi - lo + 1, dtype=np.int32) * (k + 1)), pa.array(spelled[lo:hi].ravel()))
                else:
                    own["word"] = pa.array([w.decode() for w in names[lo:hi]], pa.string())
                yield record(hi - lo, **own)


def in_blocks(rows: DataFrame, low: int, high: int, size: int) -> DataFrame:
    """Documents (doc_id, text as bytes) as ``BLOCKS``, written once."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, k, block = TaskContext.get().partitionId() << 24, 0, Block(low, high)
        for batch in batches(it):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                block.add(doc_id, text or b"")
                if block.size >= size:
                    yield from block.emit(base + k)
                    k, block = k + 1, Block(low, high)
        if block.rows:
            yield from block.emit(base + k)

    return stored(rows.mapInArrow(run, BLOCKS), "gram-blocks")


def hashed(word: Column, buckets: int) -> Column:
    return F.crc32(word.cast("binary")) % buckets


def bucketed(blocks: DataFrame, low: int, high: int, buckets: int) -> tuple[DataFrame, DataFrame]:
    """n features of each bucket; and the bucket of each block's words and tuples (block, no, bucket)."""
    words = blocks.where("word is not null").select("block", "no", "word", "n")
    dictionary = words.groupBy("word").agg(F.sum("n").alias("n"))
    # ids are fixed by being written; one word's bytes are its own
    dictionary = stored(dictionary.select("word", "n", F.monotonically_increasing_id().alias("id"), hashed(F.col("word"), buckets).alias("bucket")), "word-dictionary")
    placed = words.select("block", "no", "word").join(dictionary.select("word", "id", "bucket"), "word")
    if high == 1:
        return dictionary.groupBy("bucket").agg(F.sum("n").alias("n")), placed.select("block", "no", "bucket")
    placed = stored(placed, "placed-words")

    def name(tuples: pa.Table, words: pa.Table) -> pa.Table:
        if not tuples.num_rows:
            return pa.table({"block": pa.array([], pa.int64()), "no": pa.array([], pa.int64()), "ids": pa.array([], pa.list_(pa.int64())), "n": pa.array([], pa.int64())})
        ids = np.zeros(words.num_rows, np.int64)
        ids[words.column("no").to_numpy()] = words.column("id").to_numpy()
        parts = tuples.column("parts").combine_chunks()
        named = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(parts.value_lengths().to_numpy())]).astype(np.int32)), pa.array(ids[parts.flatten().to_numpy()]))
        return pa.table({"block": tuples.column("block"), "no": tuples.column("no"), "ids": named, "n": tuples.column("n")})

    def spell(tuples: pa.Table, words: pa.Table) -> pa.Table:
        text = dict(zip(words.column("id").to_pylist(), words.column("word").to_pylist(), strict=True)) if tuples.num_rows else {}
        return pa.table({"ids": tuples.column("ids"), "n": tuples.column("n"), "text": pa.array([" ".join(map(text.__getitem__, ids)) for ids in tuples.column("ids").to_pylist()], pa.string())})

    tuples = blocks.where("parts is not null").select("block", "no", "parts", "n")
    named = stored(tuples.groupBy("block").cogroup(placed.select("block", "no", "id").groupBy("block")).applyInArrow(name, "block long, no long, ids array<long>, n long"), "word-tuples")
    distinct = named.groupBy("ids").agg(F.sum("n").alias("n"), F.min("block").alias("block"))
    spelled = distinct.groupBy("block").cogroup(placed.select("block", "id", "word").groupBy("block")).applyInArrow(spell, "ids array<long>, n long, text string")
    spelled = stored(spelled.select("ids", "n", hashed(F.col("text"), buckets).alias("bucket")), "spelled-tuples")
    counts, where = spelled.select("bucket", "n"), named.select("block", "no", "ids").join(spelled.select("ids", "bucket"), "ids").select("block", "no", "bucket")
    if low == 1:
        counts, where = counts.unionByName(dictionary.select("bucket", "n")), where.unionByName(placed.select("block", "no", "bucket"))
    return counts.groupBy("bucket").agg(F.sum("n").alias("n")), where


def gains(source: dict[int, int], target: dict[int, int], buckets: int) -> np.ndarray:
    """Each bucket's gain, in thousandths."""
    s_all, t_all = sum(source.values()), sum(target.values())
    ratio = [(target.get(b, 0) + 1.0) * (s_all + buckets) / ((source.get(b, 0) + 1.0) * (t_all + buckets)) for b in range(buckets)]
    return np.array([math.floor(1000 * math.log(x)) for x in ratio], np.int64)


def weighted(blocks: DataFrame, where: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features, weight of each document, block by block."""

    def run(docs: pa.Table, buckets: pa.Table) -> pa.Table:
        docs = docs.combine_chunks()
        grams = [unpacked(x) for x in docs.column("grams").to_pylist()]
        n = np.array([len(x) for x in grams], np.int64)
        own = np.zeros(int(buckets.column("no").to_numpy().max(initial=-1)) + 1, np.int64)
        own[buckets.column("no").to_numpy()] = gain[buckets.column("bucket").to_numpy()]
        sums = np.array([int(own[x].sum()) for x in grams], np.int64)
        return pa.table({"doc_id": docs.column("doc_id"), "n_words": docs.column("n_words"), "n_features": pa.array(n), "weight": pa.array(np.where(n > 0, sums // np.maximum(n, 1), 0))})

    docs = blocks.where("grams is not null").select("block", "doc_id", "n_words", "grams")
    where = where.select(F.col("block").alias("home"), "no", "bucket")  # a name of its own, as both come from one table
    return docs.groupBy("block").cogroup(where.groupBy("home")).applyInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def importance_resample(
    docs: DataFrame, target: DataFrame, percent: int = 10, seed: str = "2024", orders: tuple[int, int] = (1, 1), buckets: int = 10_000, least_words: int = 20, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every document; rank is null for those not drawn."""
    low, high = orders
    if not 1 <= low <= high:
        raise ValueError("orders are from 1 up")
    blocks = in_blocks(docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("binary")), low, high, block_bytes)
    counts, where = bucketed(blocks, low, high, buckets)
    wanted, _ = bucketed(in_blocks(target.select(F.lit(0).cast("long"), F.col(text_col).cast("binary")), low, high, block_bytes), low, high, buckets)
    source, aim = ({r["bucket"]: r["n"] for r in x.collect()} for x in (counts, wanted))  # a row for each bucket
    hashed_id = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((hashed_id + 0.5) / 4294967296.0)))
    scored = stored(weighted(blocks, where, gains(source, aim, buckets)).withColumn("score", F.col("weight") + noise), "resampling-scores")
    able = F.col("n_words") >= least_words
    per_score = sorted(((r["score"], r["count"]) for r in scored.where(able).groupBy("score").count().collect()), reverse=True)  # a row for each distinct score
    size, cut = percent * sum(n for _, n in per_score) // 100, None
    left = size
    for score, n in per_score:
        if left <= 0:
            break
        cut, left = score, left - n
    drawn = able & (F.col("score") >= F.lit(cut)) if cut is not None else F.lit(False)
    ranked = numbered(scored.where(drawn).withColumn("_down", -F.col("score")), ["_down", "doc_id"], name="drawn")
    ranked = ranked.withColumn("rank", F.when(F.col("_index") < size, F.col("_index") + 1))
    rest = scored.where(~drawn).withColumn("rank", F.lit(None).cast("long"))
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    return ranked.select(*columns).unionByName(rest.select(*columns))
