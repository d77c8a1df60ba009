"""Operator 5, n-gram Jaccard join by PartEnum signatures.

Documents are sets of word shingles; two link when their Jaccard similarity is at least num / den.

*Classes.*  Documents of equal sets are one class, found by a 128-bit fingerprint; its smallest
doc_id stands for it.

*Bands.*  Sizes are cut into bands; window t takes the smaller set's band and the sizes a partner can
have, so every pair that can link lies in one window, and there its Hamming distance is at most
k(t).  The shingle domain is cut into n1 > k partitions by hash, so a pair in the window agrees on at
least n1 - k of them; a set's signature in a partition is a hash of its shingles there (PartEnum with
one-element subsets of the partitions).  n1 leaves room for partitions that are empty in both sets,
where agreement says nothing.

*Prefixes.*  A set that can differ from its partners in a window by K shingles emits its first K + 1
partitions that are not empty, in the order of partitions, and no more.  Of two sets take the one whose
prefix ends first: the other emits what it has up to there, and at most K of these K + 1 differ, so one
is equal in both.

*Tiers.*  Shingles that a bounded sample of documents shows to be common are left out of the first
tier's signatures: the count argument holds for what is left as well, and passages that many
documents share make no candidates.  A set with so many empty partitions that all agreements could be
empty (mostly common shingles, or very few) also emits signatures over its whole set, and if these
are too sparse as well, one for each shingle.  A pair can be missed by a tier only if both its sets
are sparse there, so each tier completes the one before.

*Candidates.*  Signatures travel as packed blobs, a few bytes each.  Up to FEW sets with an equal
signature give their pairs, at most FEW / 2 for each; these pass only if the sets' parity sketches,
which bound their Hamming distance from below, allow a link.  More sets are listed with the first of
them (a star, never all pairs).  All sets listed with one first set meet with their sketches, in
blocks of GROUP, and are compared unless they are connected already; only what sketches allow ties
them, so a passage that many sets share makes no component.  The connected components of both gather
what may link.

*Verification.*  The texts of a component meet in one task, where an exact prefix-filtered join,
rarest shingles first, works on the sets themselves and skips pairs that are connected already.  A
component of more than BLOCK classes is dealt in blocks, with its first set in each; what is tied to
that set is connected by then, and only the rest, of which groups of copies leave little, is compared
with all blocks.  True links are connected over the cluster.

Defined results: null, empty and blank texts have no shingles and link with nothing; a null doc_id
is kept with null component_id and links with nothing; repeated rows and equal texts are of one
class; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, release, shuffle_partitions, stored
from .components import connected_components
from .shingles import U64, mix, shingle_sets

#: Documents sampled for common shingles, and how many of them make a shingle common.
SAMPLE_DOCS, COMMON_IN_SAMPLE = 12_000, 2
#: Sets with one signature that give pairs; more give a star.
FEW = 8
#: Bytes of a signature that travel; its bucket tells some more bits.  What agrees by chance is a candidate more, no link.
SIG_BYTES = 5
#: Sets of a star whose sketches meet in one piece, or in two such.
GROUP = 2000
#: Classes of a candidate component that are joined in one piece.
BLOCK = 1000
#: Classes with more than 1 / HOT_SHARE of all documents are looked up by broadcast: fewer than HOT_SHARE.
HOT_SHARE = 10_000
#: Bits of the filter that spares most documents without candidates the second shuffle.
FILTER_BITS = 1 << 23
RATIO = 1.5


def band(lo: int, num: int, den: int) -> tuple[int, int, int, int, int]:
    """The window whose smaller sets have ``lo`` shingles at least: (lo, hi, largest partner, k, n1)."""
    hi = max(lo, math.ceil(lo * RATIO) - 1)
    top = hi * den // num
    k = (hi + top) * (den - num) // (num + den)
    n1 = k + 1
    while n1 < 2 * (k + 1) + 3:
        empty = n1 * math.exp(-lo / n1)
        if n1 - k > empty + 3 * math.sqrt(empty):
            break
        n1 += 1
    return lo, hi, top, k, n1


def bands(largest: int, num: int, den: int) -> list[tuple[int, int, int, int, int]]:
    out, lo = [], 1
    while lo <= largest:
        out.append(band(lo, num, den))
        lo = out[-1][1] + 1
    return out


def fingerprints(values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit fingerprints of each set: sums of mixed shingles."""
    out = []
    for salt in (0x1F83D9ABFB41BD6B, 0x5BE0CD19137E2179):
        total = np.zeros(len(values) + 1, U64)
        np.cumsum(mix(values ^ U64(salt)), out=total[1:])
        out.append(mix(total[at[1:]] - total[at[:-1]]).view(np.int64))
    return out[0], out[1]


def sketches(values: np.ndarray, at: np.ndarray) -> list[bytes]:
    """For each set the parities of its numbers of shingles in 2^j bins, as many as shingles or more."""
    h = mix(values ^ U64(0x9B05688C2B3E6C1F))
    out = []
    for a, z in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        bins = 1 << min(16, max(6, (z - a - 1).bit_length()))
        odd = np.bincount((h[a:z] & U64(bins - 1)).astype(np.int64), minlength=bins) & 1
        out.append(np.packbits(odd.astype(np.uint8), bitorder="little").tobytes())
    return out


def distance_bound(a: bytes, b: bytes) -> int:
    """At least so many shingles are in one of two sets only: bins of different parity."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def ties(sketch: list[bytes], size: np.ndarray, num: int, den: int) -> list[tuple[int, int]]:
    """Pairs of sets that sketches allow to link, so many that all such pairs are connected."""
    order = np.argsort(size, kind="stable")
    size = size[order]
    width = np.array([len(sketch[i]) for i in order.tolist()])  # ascends with the size
    home = np.arange(len(order))
    out: list[tuple[int, int]] = []
    for w in np.unique(width).tolist():
        # a partner that is not smaller has a sketch of this width, or one of twice the width
        a, b, z = np.searchsorted(width, [w, w + 1, 2 * w + 1]).tolist()
        table = np.frombuffer(b"".join(sketch[i] for i in order[a:b].tolist()), np.uint64).reshape(b - a, -1)
        if z > b:
            wide = np.frombuffer(b"".join(sketch[i] for i in order[b:z].tolist()), np.uint64).reshape(z - b, 2, -1)
            table = np.concatenate([table, wide[:, 0] ^ wide[:, 1]])
        last = np.searchsorted(size[:z], size[a:b] * den // num, side="right")
        for i, end in zip(range(a, b), last.tolist(), strict=True):
            others = i + 1 + np.flatnonzero(home[i + 1 : end] != home[i])
            if not len(others):
                continue
            apart = np.bitwise_count(table[others - a] ^ table[i - a]).sum(1, dtype=np.int64)
            close = others[apart * (num + den) <= (size[others] + size[i]) * (den - num)]
            if len(close):
                met, first = np.unique(home[close], return_index=True)
                out += [(int(order[i]), int(order[j])) for j in close[first].tolist()]
                home[np.isin(home, met)] = home[i]
    return out


def signatures(values: np.ndarray, owner: np.ndarray, size: np.ndarray, common: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """(signature, set number) of sets given as ascending ``values`` with ``owner``; ``size`` is |set|."""
    sigs: list[np.ndarray] = []
    refs: list[np.ndarray] = []

    def partition(tier: int, t: int, n1: int, most: np.ndarray, chosen: np.ndarray, v: np.ndarray, o: np.ndarray) -> np.ndarray:
        """Emit signatures of the first ``most + 1`` partitions that are not empty; the chosen sets that have too few."""
        e = chosen[o]
        v, o = v[e], o[e]
        part = ((v >> U64(32)) * U64(n1)) >> U64(32)
        key = o.astype(U64) * U64(n1) + part
        full = np.zeros(len(size), np.int64)
        if len(key):
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            body = np.add.reduceat(mix(v ^ U64(0x3C6EF372FE94F82B + tier)), first)
            ref = o[first]
            full = np.bincount(ref, minlength=len(size))
            prefix = np.arange(len(ref)) - (np.cumsum(full) - full)[ref] <= most[ref]
            sigs.append(mix(body + mix(part[first] + (U64(t) << U64(33)) + (U64(tier) << U64(60))))[prefix])
            refs.append(ref[prefix])
        return chosen & (full <= most)

    if not len(size):
        return np.zeros(0, U64), np.zeros(0, np.int64)
    if len(common):
        at = np.minimum(np.searchsorted(common, values), len(common) - 1)
        rare = common[at] != values
        rare_v, rare_o = values[rare], owner[rare]
    else:
        rare_v, rare_o = values, owner
    for t, (lo, hi, top, _, n1) in enumerate(bands(int(size.max()), num, den)):
        sparse = (size >= lo) & (size <= top)
        if not sparse.any():
            continue
        # a partner has num / den to den / num of the size, and the smaller of both is in the band
        partner = np.where(size > hi, hi, np.minimum(size * den // num, top))
        most = (size + partner) * (den - num) // (num + den)
        for tier, (v, o) in enumerate(((rare_v, rare_o), (values, owner))):
            sparse = partition(tier, t, n1, most, sparse, v, o)
            if not sparse.any():
                break
        else:
            e = sparse[owner]
            sigs.append(mix(values[e] ^ U64(0x510E527FADE682D1 + t)))
            refs.append(owner[e])
    if not sigs:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    return np.concatenate(sigs), np.concatenate(refs)


def link(sets: list[np.ndarray], num: int, den: int) -> list[int]:
    """Exact components of a Jaccard join of sets: for each set the number of its component's first.

    Prefix filter with the rarest shingles first; candidates in the same component are skipped.
    """
    n = len(sets)
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    bounds = np.cumsum([0, *map(len, sets)])
    sizes = [len(s) for s in sets]
    _, inverse, counts = np.unique(np.concatenate(sets) if sets else np.zeros(0, U64), return_inverse=True, return_counts=True)
    inverse, counts = inverse.astype(np.int32), counts.astype(np.int32)
    #: Sets whose prefix holds a shingle: one, a list of a few, or lists by component.
    index: dict[int, int | list[int] | dict[int, list[int]]] = {}

    def verified(x: int, y: int, own: np.ndarray) -> bool:
        if sizes[y] * den < sizes[x] * num:
            return False
        both = int(np.isin(own, inverse[bounds[y] : bounds[y + 1]], assume_unique=True).sum())
        return den * both >= num * (sizes[x] + sizes[y] - both)

    for x in sorted(range(n), key=lambda i: (sizes[i], i)):
        size = sizes[x]
        if not size:
            continue
        own = inverse[bounds[x] : bounds[x + 1]]
        prefix = own[np.lexsort((own, counts[own]))[: size - -(-size * num // den) + 1]]
        mine = prefix[counts[prefix] > 1].tolist()
        tried: set[int] = set()
        for e in mine:
            places = index.get(e)
            if places is None:
                continue
            groups = places.values() if isinstance(places, dict) else [[y] for y in ([places] if isinstance(places, int) else places)]
            for ys in groups:
                if find(ys[0]) == find(x):
                    continue
                for y in ys:
                    if y not in tried:
                        tried.add(y)
                        if verified(x, y, own):
                            a, b = sorted((find(x), find(y)))
                            root[b] = a
                            break
        for e in mine:
            places = index.get(e)
            if places is None:
                index[e] = x
            elif isinstance(places, int):
                index[e] = [places, x]
            elif isinstance(places, list):
                places.append(x)
            else:
                places.setdefault(find(x), []).append(x)
            held = 0 if isinstance(index[e], int) else len(index[e])
            if held > 8 and (isinstance(index[e], list) or not held & (held - 1)):
                # sets in one component are listed together, so a whole component is skipped at once
                members = index[e] if isinstance(index[e], list) else [y for ys in index[e].values() for y in ys]
                merged: dict[int, list[int]] = {}
                for y in members:
                    merged.setdefault(find(y), []).append(y)
                index[e] = merged
    return [find(x) for x in range(n)]


def _common_shingles(docs: DataFrame, total: int, width: int) -> np.ndarray:
    """Shingles that several documents of a bounded sample hold: SAMPLE_DOCS sets at most, about."""

    def sets(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it):
            values, _ = shingle_sets(batch.column(0), width)
            yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64))], ["shingle"])

    # equal texts count once: what only copies share is no common passage
    sample = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(max(1, total))) < SAMPLE_DOCS).select("text").distinct()
    counted = sample.mapInArrow(sets, "shingle long").groupBy("shingle").count().where(F.col("count") >= COMMON_IN_SAMPLE)
    return np.sort(np.array([r["shingle"] for r in counted.select("shingle").collect()], np.int64).view(U64))


def id_filter(ids: DataFrame, column: str) -> np.ndarray:
    """A filter of bounded size: the bits of the ids' hashes.  It may let others pass, but loses none."""
    slot = F.pmod(F.xxhash64(column), F.lit(FILTER_BITS))
    bit = F.expr(f"shiftleft(1L, cast(pmod(xxhash64(`{column}`), {FILTER_BITS}) & 31 as int))")
    words = ids.select(F.shiftright(slot.cast("int"), 5).alias("w"), bit.alias("b")).groupBy("w").agg(F.bit_or("b").alias("b"))
    table = np.zeros(FILTER_BITS // 32, np.int64)
    for r in words.collect():  # FILTER_BITS / 32 rows at most
        table[r["w"]] = r["b"]
    return table


def hits(rows: DataFrame, table: np.ndarray, column: str, wanted: bool = True) -> DataFrame:
    """Rows whose id may be in the filter, or those whose id is certainly not."""
    shared = rows.sparkSession.sparkContext.broadcast(table)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            s = batch.column("__curatrix_slot").to_numpy()
            yield batch.filter(pa.array((shared.value[s >> 5] >> (s & 31) & 1).astype(bool) == wanted))

    slotted = rows.select("*", F.pmod(F.xxhash64(column), F.lit(FILTER_BITS)).cast("int").alias("__curatrix_slot"))
    return slotted.mapInArrow(run, slotted.schema).select(*rows.columns)


def jaccard_classes(docs: DataFrame, width: int = 5, num: int = 3, den: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each document: doc_id, n_shingles, component_id."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def measure(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it):
            values, at = shingle_sets(batch.column(1), width)
            f1, f2 = fingerprints(values, at)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(at)), pa.array(f1), pa.array(f2), pa.array(sketches(values, at), pa.binary())], ["doc_id", "n_shingles", "f1", "f2", "sketch"])

    sets = stored(rows.mapInArrow(measure, "doc_id long, n_shingles long, f1 long, f2 long, sketch binary"), "sets")
    total = sets.count()
    usable = sets.where("doc_id is not null and n_shingles > 0")
    classes = stored(usable.groupBy("f1", "f2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")), "set-classes")
    hot = {(r["f1"], r["f2"]): r["rep"] for r in classes.where(F.col("n") * HOT_SHARE > total).select("f1", "f2", "rep").collect()}
    common = spark.sparkContext.broadcast(_common_shingles(rows, total, width))
    buckets = shuffle_partitions(spark)

    def emit(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Signatures of a batch, packed by bucket: set fingerprints, signatures of each, signatures."""
        for batch in batches(it):
            values, at = shingle_sets(batch.column(1), width)
            f1, f2 = fingerprints(values, at)
            size = np.diff(at)
            wanted = (size > 0) & ~np.asarray(batch.column(0).is_null())
            both = list(zip(f1.tolist(), f2.tolist(), strict=True))
            if hot:
                wanted &= np.array([hot.get(f, d) == d for f, d in zip(both, batch.column(0).to_pylist(), strict=True)], bool)
            # copies in one batch emit once
            first: dict[tuple[int, int], int] = {}
            for i in np.flatnonzero(wanted).tolist():
                first.setdefault(both[i], i)
            wanted = np.zeros(len(size), bool)
            wanted[list(first.values())] = True
            owner = np.repeat(np.arange(len(size)), size)
            keep = wanted[owner]
            sig, ref = signatures(values[keep], owner[keep], np.where(wanted, size, 0), common.value, num, den)
            bucket = (((sig >> U64(32)) * U64(buckets)) >> U64(32)).astype(np.int64)
            order = np.lexsort((ref, bucket))
            sig, ref, bucket = sig[order], ref[order], bucket[order]
            edges = np.searchsorted(bucket, np.arange(buckets + 1))
            low = np.ascontiguousarray(sig.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :SIG_BYTES])
            out: list[list] = [[], [], [], []]
            for b in range(buckets):
                a, z = edges[b], edges[b + 1]
                if a == z:
                    continue
                new = np.concatenate([[True], ref[a + 1 : z] != ref[a : z - 1]])
                at_new = np.maximum.accumulate(np.where(new, np.arange(z - a), 0))
                start = a + np.flatnonzero((np.arange(z - a) - at_new) % 255 == 0)  # counts are single bytes
                out[0].append(b)
                out[1].append(f1[ref[start]].astype("<i8").tobytes())
                out[2].append(np.diff(np.append(start, z)).astype(np.uint8).tobytes())
                out[3].append(low[a:z].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), *[pa.array(x, pa.binary()) for x in out[1:]]], ["bucket", "sets", "counts", "sigs"])

    def meet(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sets with an equal signature: pairs of a few, or a star."""
        refs, sigs = [], []
        for batch in it:
            for s, c, g in zip(*(batch.column(x).to_pylist() for x in ("sets", "counts", "sigs")), strict=True):
                refs.append(np.repeat(np.frombuffer(s, "<i8"), np.frombuffer(c, np.uint8)))
                wide = np.zeros((len(g) // SIG_BYTES, 8), np.uint8)
                wide[:, :SIG_BYTES] = np.frombuffer(g, np.uint8).reshape(-1, SIG_BYTES)
                sigs.append(wide.view("<u8").ravel())
        if not refs:
            return
        release()
        ref, sig = np.concatenate(refs), np.concatenate(sigs)
        del refs, sigs
        order = np.lexsort((ref, sig))
        ref, sig = ref[order], sig[order]
        del order
        once = np.concatenate([[True], (sig[1:] != sig[:-1]) | (ref[1:] != ref[:-1])])
        ref, sig = ref[once], sig[once]
        start = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
        count = np.diff(np.append(start, len(sig)))
        found = []
        for m in range(2, FEW + 1):
            group = ref[start[count == m][:, None] + np.arange(m)]
            found += [np.stack([group[:, j], group[:, i], np.zeros(len(group), np.int64)], axis=1) for i in range(m) for j in range(i + 1, m)]
        for at, m in zip(start[count > FEW].tolist(), count[count > FEW].tolist(), strict=True):
            found.append(np.stack([ref[at + 1 : at + m], np.full(m - 1, ref[at]), np.ones(m - 1, np.int64)], axis=1))
        del ref, sig, once
        pairs = np.unique(np.concatenate(found), axis=0)
        del found
        release()
        for lo in range(0, len(pairs), 100_000):
            part = pairs[lo : lo + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part[:, 0]), pa.array(part[:, 1]), pa.array(part[:, 2] == 1)], ["u", "v", "star"])

    def allowed(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs that can link by their sketches."""
        for batch in it:
            keep = [
                distance_bound(x, y) <= (a + b) * (den - num) // (num + den)
                for x, y, a, b in zip(*(batch.column(c).to_pylist() for c in ("u_sketch", "v_sketch", "u_size", "v_size")), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v")], ["u", "v"]).filter(pa.array(keep, pa.bool_()))

    def tie(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What sketches allow to link among the sets of each star, or of two blocks of it."""
        ids: list[np.ndarray] = []
        sketch: list[bytes] = []
        size: list[np.ndarray] = []
        last = None

        def solved() -> pa.RecordBatch:
            f1 = np.concatenate(ids)
            found = np.array(ties(sketch, np.concatenate(size), num, den), np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(f1[found[:, 0]]), pa.array(f1[found[:, 1]])], ["u", "v"])

        for batch in it:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(c).to_numpy() for c in ("hub", "a", "b")], axis=1)
            starts = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(axis=1)])).tolist()
            for lo, hi in zip(starts, [*starts[1:], batch.num_rows], strict=True):
                if (now := tuple(key[lo].tolist())) != last:
                    if len(sketch) > 1:
                        yield solved()
                    ids, sketch, size, last = [], [], [], now
                part = batch.slice(lo, hi - lo)
                ids.append(part.column("f1").to_numpy())
                sketch += part.column("sketch").to_pylist()
                size.append(part.column("n_shingles").to_numpy())
        if len(sketch) > 1:
            yield solved()
        release()

    packed = rows.mapInArrow(emit, "bucket int, sets binary, counts binary, sigs binary").repartitionById(buckets, F.col("bucket"))
    met = stored(packed.mapInArrow(meet, "u long, v long, star boolean"), "met")
    pairs = met.where("not star").select("u", "v").distinct()
    listed = met.where("star").select(F.col("u").alias("f1"), F.col("v").alias("hub")).distinct()
    stars = stored(listed.unionByName(listed.select(F.col("hub").alias("f1"), "hub").distinct()), "stars")
    asked = met.select(F.explode(F.array("u", "v")).alias("f1")).distinct().join(classes.select("f1", "f2", "rep"), "f1")
    known = stored(asked.join(sets.select(F.col("doc_id").alias("rep"), "f1", "f2", "sketch", "n_shingles"), ["rep", "f1", "f2"]).dropDuplicates(["f1", "f2"]).select("f1", "sketch", "n_shingles"), "sketches")
    side = lambda k: known.select(F.col("f1").alias(k), F.col("sketch").alias(f"{k}_sketch"), F.col("n_shingles").alias(f"{k}_size"))
    close = pairs.join(side("u"), "u").join(side("v"), "v").mapInArrow(allowed, "u long, v long")
    # a large star is dealt in blocks, each of which meets each
    split = stars.groupBy("hub").count().where(F.col("count") > GROUP).select("hub", F.ceil(F.col("count") / GROUP).cast("int").alias("blocks"))
    own, other = F.pmod(F.xxhash64("f1"), F.col("blocks")).cast("int"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    cut = stars.join(split, "hub", "left").select("f1", "hub", own.alias("own"), "blocks")
    whole = cut.where("blocks is null").select("f1", "hub", F.lit(0).alias("a"), F.lit(0).alias("b"))
    blocks = cut.where("blocks is not null").select("f1", "hub", "own", other).select("f1", "hub", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"))
    meeting = whole.unionByName(blocks).join(known, "f1").repartition("hub", "a", "b").sortWithinPartitions("hub", "a", "b")
    # of two sets with one f1 either may allow the pair; both come along with it
    edges = close.unionByName(meeting.mapInArrow(tie, "u long, v long"))
    reach = connected_components(edges, "candidates")
    # v is a component's smallest set, which has no row of its own
    near = reach.select(F.col("node").alias("f1"), F.col("component").alias("home")).unionByName(
        reach.select(F.col("component").alias("f1"), F.col("component").alias("home")).distinct()
    )
    found = stored(classes.select("f1", "f2", "rep").join(near, "f1"), "candidate-classes")

    texts = hits(rows.where("doc_id is not null"), id_filter(found, "rep"), "doc_id")
    sizes = found.groupBy("home").count().where(F.col("count") > BLOCK).select("home", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    spread = found.join(sizes, "home", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    homes = stored(spread.withColumn("block", F.pmod(F.xxhash64("f1", "f2"), F.col("blocks")).cast("int")), "candidate-homes")

    def verify(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        held: list[np.ndarray] = []
        last = None
        out: list[tuple[int, int]] = []

        def solve() -> None:
            for x, r in enumerate(link(held, num, den)):
                if ids[x] != ids[r]:
                    out.append((ids[x], ids[r]))

        for batch in batches(it):
            values, at = shingle_sets(batch.column("text"), width)
            f1, f2 = fingerprints(values, at)
            same = (f1 == batch.column("f1").to_numpy()) & (f2 == batch.column("f2").to_numpy())  # a repeated doc_id may have other texts
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("home", "a", "b")), strict=True))
            docs_in = batch.column("doc_id").to_pylist()
            for i, key in enumerate(keys):
                if key != last:
                    if len(held) > 1:
                        solve()
                    ids, held, last = [], [], key
                if same[i]:
                    ids.append(docs_in[i])
                    held.append(values[at[i] : at[i + 1]])
        if len(held) > 1:
            solve()
        if out:
            u, v = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    def joined_within(deal: DataFrame) -> DataFrame:
        """Links found where ``deal`` (rep, f1, f2, home, a, b) brings texts together."""
        key = ["home", "a", "b"]
        dealt = texts.join(deal.withColumnRenamed("rep", "doc_id"), "doc_id")
        return dealt.repartition(*key).sortWithinPartitions(*key, "doc_id").mapInArrow(verify, "u long, v long")

    # First every block by itself; the component's first set is in all of its blocks and ties together what is like it.
    ends = F.when(F.col("f1") == F.col("home"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("block"))
    once = homes.select("rep", "f1", "f2", "home", F.explode(ends).alias("a"), F.lit(0).alias("b"))
    linked = connected_components(joined_within(once), "linked")
    large = homes.where("blocks > 1")
    if large.limit(1).count():
        # Then the sets that are not tied to it, if any, in blocks of their own against all blocks.
        placed = stored(large.join(linked, F.col("rep") == F.col("node"), "left").withColumn("part", F.coalesce("component", "rep")).drop("node", "component"), "candidate-parts")
        main = placed.where("f1 = home").select("home", F.col("part").alias("main"))
        rest = placed.join(main, "home").where("part <> main")
        if rest.limit(1).count():
            rounds = rest.groupBy("home").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("groups"))
            left = rest.join(rounds, "home").select("rep", "f1", "f2", "home", F.pmod(F.xxhash64("f2", "f1"), F.col("groups")).cast("int").alias("a"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("b"))
            right = placed.join(rounds, "home").select("rep", "f1", "f2", "home", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("a"), F.col("block").alias("b"))
            across = stored(left.unionByName(right).distinct(), "candidate-rest")
            linked = connected_components(joined_within(across).unionByName(linked.select(F.col("node").alias("u"), F.col("component").alias("v"))), "linked")
    solved = classes.join(linked, F.col("rep") == F.col("node"), "left").select("f1", "f2", F.coalesce("component", "rep").alias("component"))
    joined = sets.join(solved, ["f1", "f2"], "left")
    return joined.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))


def distinct_documents(docs: DataFrame, width: int = 5, num: int = 3, den: int = 4) -> DataFrame:
    """One document of each group, with all columns: the one whose doc_id is its component.

    Documents without doc_id stay; of rows that repeat that doc_id all stay, as nothing tells them apart.
    """
    classes = jaccard_classes(docs.select("doc_id", "text"), width, num, den)
    gone = stored(classes.where("doc_id <> component_id").select("doc_id"), "gone")
    table = id_filter(gone, "doc_id")
    # most documents that stay are told by the filter and need no shuffle
    unsure = hits(docs, table, "doc_id").join(gone, "doc_id", "left_anti").select(*docs.columns)
    return hits(docs, table, "doc_id", wanted=False).unionByName(unsure)
