"""Operator 9, embedding near-duplicates by random-hyperplane sign hashing.

Equal vectors of a label are one class (its smallest id stands for it, its size is its weight), so a
hot vector costs one row.  A class's signs towards ``bits`` fixed hyperplanes are its code in a
table, all its codes together its sketch.  ``bits`` follows the number of classes, and the number of
tables follows from the recall asked for at the threshold itself (pairs above it are found more often).

Sketches, not vectors, travel to the buckets of all tables.  In a bucket of one label and code, two
sketches that differ in more bits than MARGIN standard deviations above what the threshold lets expect
are no candidates, and a pair that met in an earlier table was dealt with there.  Only classes with a
candidate left in a bucket come again with their vectors, and are compared by cosine in double precision.
Buckets above ``BLOCK`` rows are compared in pairs of blocks by separate tasks.  No pairs leave a task: a
bucket gives each member its number of links and a local component, and components are joined up over
the cluster.

Defined results: a vector that is null, empty, zero, or holds a null or non-finite component, and
any vector whose label is null, has no links and is its own component; vectors of different length
are never compared; rows with null vec_id are ignored; of repeated rows each counts as a vector;
other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .components import connected_components

#: Rows of a bucket that are compared in one piece.
BLOCK = 4096
#: Classes that a bucket of random vectors should hold, about.
BUCKET = 64
#: Standard deviations of a sketch's differing bits that a pair at the threshold may lie above the mean.
MARGIN = 4.5


def tables_for(threshold: float, bits: int, recall: float) -> int:
    """Tables that find a pair right at the threshold with this probability."""
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return max(1, math.ceil(math.log(1 - recall) / math.log1p(-same)))


def sign_codes(vectors: np.ndarray, bits: int, tables: int, seed: int) -> np.ndarray:
    """Codes (rows x tables) of unit vectors."""
    planes = np.random.default_rng(seed).standard_normal((vectors.shape[1], tables * bits))
    signs = (vectors @ planes > 0).reshape(len(vectors), tables, bits)
    return signs @ (1 << np.arange(bits, dtype=np.int64))


def packed_codes(codes: np.ndarray, bits: int) -> np.ndarray:
    """Codes (rows x tables) as rows of bytes."""
    return np.packbits(codes[:, :, None] >> np.arange(bits) & 1, axis=2, bitorder="little").reshape(len(codes), -1)


def unpacked_codes(sketches: np.ndarray, tables: int) -> np.ndarray:
    per = sketches.shape[1] // tables
    return (sketches.reshape(len(sketches), tables, per).astype(np.int64) << (8 * np.arange(per))).sum(axis=2)


def most_differing(threshold: float, bits: int) -> int:
    """Bits in which sketches of a pair at the threshold differ, but for rare luck."""
    p = math.acos(threshold) / math.pi
    return math.floor(bits * p + MARGIN * math.sqrt(bits * p * (1 - p)))


def has_candidate(sketches: np.ndarray, block: np.ndarray, within: bool, table: int, tables: int, most: int) -> np.ndarray:
    """Which rows of a bucket have another that is near by sketch and was not met in an earlier table."""
    n = len(sketches)
    wide = np.zeros((n, -(-sketches.shape[1] // 8) * 8), np.uint8)
    wide[:, : sketches.shape[1]] = sketches
    words, codes = wide.view(np.uint64), unpacked_codes(sketches, tables)[:, :table]
    found = np.zeros(n, bool)
    step = max(1, (1 << 20) // n)
    for lo in range(0, n, step):
        apart = np.zeros((min(step, n - lo), n), np.int64)
        for w in words.T:
            apart += np.bitwise_count(w[lo : lo + step, None] ^ w)
        i, j = np.nonzero(apart <= most)
        i += lo
        keep = (i < j) if within else (i < j) & (block[i] != block[j])
        i, j = i[keep], j[keep]
        for a in range(0, len(i), 1 << 18):
            x, y = i[a : a + (1 << 18)], j[a : a + (1 << 18)]
            fresh = ~(codes[x] == codes[y]).any(axis=1)
            found[x[fresh]] = found[y[fresh]] = True
    return found


def grouped(it: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    """Rows of equal keys, which follow one another, as one batch each."""
    last, held = None, []
    for batch in it:
        marks = [batch.column(c).to_numpy(zero_copy_only=False) for c in keys]
        change = np.zeros(batch.num_rows, bool)
        for m in marks:
            change[1:] |= m[1:] != m[:-1]
        starts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for lo, hi in zip(starts[:-1], starts[1:], strict=True):
            if lo == hi:
                continue
            this = tuple(m[lo] for m in marks)
            if this != last and held:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0] if len(held) > 1 else held[0]
                held = []
            last = this
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0] if len(held) > 1 else held[0]


def unit(vectors: np.ndarray) -> np.ndarray:
    wide = vectors.astype(np.float64)
    wide /= np.abs(wide).max(axis=1, keepdims=True)  # squares of very small or large components stay in range
    return wide / np.linalg.norm(wide, axis=1, keepdims=True)


def compare(ids: np.ndarray, weights: np.ndarray, block: np.ndarray, within: bool, codes: np.ndarray, table: int, vectors: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Of one bucket: each row's weight of links new in this table, and its local component.

    ``within``: pairs inside a block count, otherwise those across two blocks.
    """
    n = len(ids)
    x = unit(vectors)
    links, label = np.zeros(n, np.int64), np.arange(n)
    step = max(1, (1 << 21) // n)
    for lo in range(0, n, step):
        close = x[lo : lo + step] @ x.T >= threshold
        i, j = np.nonzero(close)
        i += lo
        keep = (i != j) if within else (block[i] != block[j])
        i, j = i[keep], j[keep]
        fresh = ~(codes[i, :table] == codes[j, :table]).any(axis=1)
        i, j = i[fresh], j[fresh]
        if not len(i):
            continue
        np.add.at(links, i, weights[j])
        rows, first = np.unique(i, return_index=True)
        for row, near in zip(rows, np.split(j, first[1:]), strict=True):
            met = np.unique(np.append(label[near], label[row]))
            if len(met) > 1:
                label[np.isin(label, met)] = met[0]
    least = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(least, label, ids)
    return links, least[label]


def near_duplicate_vectors(
    vectors: DataFrame, threshold: float = 0.93, recall: float = 0.995, seed: int = 17, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """A row for each vector: vec_id, n_links, component_id, kept."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector"), F.col(label_col).alias("label")).where("vec_id is not null")
    sound = (
        F.col("label").isNotNull()
        & F.col("vector").isNotNull()
        & ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists("vector", lambda x: x != 0)
    )
    keyed = rows.select("vec_id", "label", "vector", F.coalesce(sound, F.lit(False)).alias("sound")).select(
        "vec_id", "label", "vector", "sound", F.when(F.col("sound"), F.xxhash64("label", "vector")).alias("h1"), F.when(F.col("sound"), F.xxhash64(F.lit("second"), "vector", "label")).alias("h2")
    )
    classes = stored(
        keyed.where("sound").groupBy("h1", "h2").agg(F.min("vec_id").alias("id"), F.count("*").alias("weight"), F.first("label").alias("label"), F.first("vector").alias("vector")),
        "vector-classes",
    )
    n = classes.count()
    bits = max(8, math.ceil(math.log2(max(1, n) / BUCKET)))
    tables = tables_for(threshold, bits, recall)

    def hashed(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in it:
            for lo in range(0, whole.num_rows, 1000):
                batch = whole.slice(lo, 1000)
                dims = np.diff(batch.column("vector").offsets.to_numpy())
                for dim in np.unique(dims):
                    part = batch.filter(pa.array(dims == dim))
                    x = part.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                    codes = sign_codes(unit(x), bits, tables, seed)
                    m = len(codes)
                    sketches = pa.array([row.tobytes() for row in packed_codes(codes, bits)], pa.binary())
                    again = pa.array(np.repeat(np.arange(m), tables))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.tile(np.arange(tables, dtype=np.int32), m)), pa.array(np.full(m * tables, dim, np.int32)), part.column("label").take(again), pa.array(codes.ravel()), part.column("id").take(again), sketches.take(again)],
                        ["t", "dim", "label", "code", "id", "sketch"],
                    )

    kinds = {f.name: f.dataType.simpleString() for f in classes.schema}
    key = ["t", "dim", "label", "code"]
    entries = classes.select("id", "label", "vector").mapInArrow(hashed, f"t int, dim int, label {kinds['label']}, code long, id long, sketch binary")
    # Buckets too large for one comparison, with their number of blocks: at most entries / BLOCK rows.
    hot = stored(entries.groupBy(*key).count().where(F.col("count") > BLOCK).select(*key, F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")), "hot-buckets")
    if hot.count():
        blocked = entries.join(hot, key, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: F.struct(F.least("block", b).alias("a"), F.greatest("block", b).alias("b")))
        entries = blocked.withColumn("pair", F.explode(pairs)).select(*key, F.col("pair.a").alias("a"), F.col("pair.b").alias("b"), "block", "id", "sketch")
    else:
        entries = entries.select(*key, F.lit(0).alias("a"), F.lit(0).alias("b"), F.lit(0).alias("block"), "id", "sketch")
    order = [*key, "a", "b"]
    most = most_differing(threshold, bits * tables)

    def sketch_rows(group: pa.RecordBatch) -> np.ndarray:
        return np.frombuffer(b"".join(group.column("sketch").to_pylist()), np.uint8).reshape(group.num_rows, -1)

    def near(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Members of buckets that have a candidate there."""
        for group in grouped(it, tuple(order)):
            if group.num_rows > 1:
                keep = has_candidate(sketch_rows(group), group.column("block").to_numpy(), group.column("a")[0] == group.column("b")[0], group.column("t")[0].as_py(), tables, most)
                if keep.any():
                    yield group.filter(pa.array(keep))

    def buckets(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[list[np.ndarray]] = [[], [], []]

        def flush() -> pa.RecordBatch:
            columns = [pa.array(np.concatenate(c)) for c in out]
            for c in out:
                c.clear()
            return pa.RecordBatch.from_arrays(columns, ["id", "links", "local"])

        for group in grouped(it, tuple(order)):
            ids, weights, block = (group.column(c).to_numpy() for c in ("id", "weight", "block"))
            x = group.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
            codes = unpacked_codes(sketch_rows(group), tables)
            links, local = compare(ids, weights, block, group.column("a")[0] == group.column("b")[0], codes, group.column("t")[0].as_py(), x, threshold)
            some = links > 0
            if some.any():
                for column, values in zip(out, (ids[some], links[some], local[some]), strict=True):
                    column.append(values)
            if sum(map(len, out[0])) > 50_000:
                yield flush()
        if out[0]:
            yield flush()

    candidates = stored(entries.repartition(*order).sortWithinPartitions(*order).mapInArrow(near, entries.schema), "vector-candidates")
    with_vectors = candidates.join(classes.select("id", "weight", "vector"), "id")
    found = stored(with_vectors.repartition(*order).sortWithinPartitions(*order).mapInArrow(buckets, "id long, links long, local long"), "vector-links")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    reach = connected_components(found.where("id <> local").select(F.col("id").alias("u"), F.col("local").alias("v")), "vector-components")
    solved = (
        classes.select("h1", "h2", "id", "weight")
        .join(links, "id", "left")
        .join(reach.withColumnRenamed("node", "id"), "id", "left")
        .select("h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    )
    joined = keyed.select("vec_id", "h1", "h2").join(solved, ["h1", "h2"], "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))
