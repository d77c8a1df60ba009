"""Operator 13, periodic runs of words by bit-parallel lags.

The distinct words of a text get ids in order of appearance.  Bit b of all ids makes one big integer, a
bit plane.  For a lag q every plane is XORed with itself shifted by q; the OR of the results has a zero
where a word equals the one q places on.  Of the complement, ANDs with shifts that double keep just the
places from which enough equal words follow, so a lag without a run costs a few operations on whole
planes.  A stretch at lag q with a smaller period p has a p that divides q (it is at least p + q long),
and then lies within a run found at lag p before.

Lags below ``DIRECT`` are all tried.  A larger lag q with B <= q < 2B, B a power of two, can have a run
only if the B words at some multiple p of B recur at p + q, as the run's equal words cover a whole such
block; hashes of all windows of B words name the lags for which that is so, in time in proportion to
the text, and only these are tried.  Equal windows have equal hashes, so no run is lost, and what the
planes say decides.

Each text is worked on by itself, without any shuffle.  Memory is in proportion to the text: its words,
their ids, and a bit for each word and plane.

Defined results: a null or empty text, or one of white space, has no words, no runs, and collapses to an
empty text; a text that is one repeated word is one run; words that are equal differ in no way, so ties
need no rule but the order of runs (by start, then period); repeated rows give the same result each; a
null id is kept; other columns are ignored; very long texts are worked on whole; an empty table gives
no rows.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, text_list
from .shingles import U64, mix, powers

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Lags below it are all tried.
DIRECT = 64

Run = tuple[int, int, int]  # start, length, period
Rewrite = Callable[[int | None, list[str]], list[str]]

SCHEMA = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def word_ids(words: list[str]) -> np.ndarray:
    seen: dict[str, int] = defaultdict()
    seen.default_factory = seen.__len__
    return np.fromiter(map(seen.__getitem__, words), np.int32, len(words))


def bit_planes(ids: np.ndarray) -> list[int]:
    """Integer b has bit b of every id, that of word i at place i."""
    bits = np.arange(max(1, int(ids.max()).bit_length()), dtype=np.int32)[:, None]
    packed = np.packbits((ids >> bits & 1).astype(np.uint8), axis=1, bitorder="little")
    return [int.from_bytes(row.tobytes(), "little") for row in packed]


def long_stretches(ones: int, need: int) -> list[tuple[int, int]]:
    """First place and end of all stretches of at least ``need`` ones, ascending."""
    have = 1
    while ones and have < need:
        step = min(have, need - have)
        ones &= ones >> step
        have += step
    # bit i is now set if ``need`` ones begin at i
    out, base = [], 0
    while ones:
        zeros = (ones & -ones).bit_length() - 1
        ones >>= zeros
        run = (~ones & (ones + 1)).bit_length() - 1
        out.append((base + zeros, base + zeros + run - 1 + need))
        ones >>= run
        base += zeros + run
    return out


def screened_lags(ids: np.ndarray, most: int) -> Iterator[int]:
    """Lags from ``DIRECT`` to ``most`` at which a block of words recurs, ascending."""
    n, size = len(ids), DIRECT
    up, down = powers(n + 1)
    sums = np.zeros(n + 1, U64)
    np.cumsum(mix(ids.astype(U64) + U64(1)) * up[:n], out=sums[1:])
    while size <= most:
        windows = (sums[size:] - sums[:-size]) * down[: n - size + 1]
        rows = -(-len(windows) // size)
        table = np.zeros((rows, size), U64)
        table.reshape(-1)[: len(windows)] = windows
        for lag in (np.flatnonzero((table[1:] == table[:-1, :1]).any(axis=0)) + size).tolist():
            if lag <= most:
                yield lag
        size *= 2


def find_runs(ids: np.ndarray, shortest: int = 6, repeats: int = 4) -> list[Run]:
    """All runs, by start, then period.

    A run is a stretch with smallest period q, of at least max(``shortest``, ``repeats`` * q) words, that
    no word on either side extends.
    """
    n = len(ids)
    most = n // repeats
    if n < shortest or not most:
        return []
    planes = bit_planes(ids)
    whole = (1 << n) - 1
    found: dict[int, tuple[list[int], list[int]]] = {}
    lags = iter(range(1, min(DIRECT - 1, most) + 1))
    for lags in (lags, screened_lags(ids, most) if most >= DIRECT else ()):
        for q in lags:
            mismatch = 0
            for p in planes:
                mismatch |= p ^ (p >> q)
            for start, end in long_stretches((whole >> q) & ~mismatch, max(shortest, repeats * q) - q):
                end += q
                if not any(q % p == 0 and (i := bisect_right(starts, start)) and ends[i - 1] >= end for p, (starts, ends) in found.items() if p < q):
                    starts, ends = found.setdefault(q, ([], []))
                    starts.append(start)
                    ends.append(end)
    return sorted((start, end - start, q) for q, (starts, ends) in found.items() for start, end in zip(starts, ends, strict=True))


def collapse(words: list[str], runs: list[Run]) -> list[str]:
    """The words without those that repeat a run's first period."""
    if not runs:
        return words
    gone = np.zeros(len(words) + 1, np.int32)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    return [w for w, g in zip(words, np.cumsum(gone).tolist(), strict=False) if not g]


def periodic_runs(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", shortest: int = 6, repeats: int = 4, rewrite: Rewrite | None = None) -> DataFrame:
    """Each document's number of words, its runs, and its text collapsed, words joined by one space.

    ``rewrite`` may give other words for (id, words) first.
    """
    if repeats < 3 or shortest < 2:
        raise ValueError("at least three repeats and two words are needed")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it):
            sizes, ends, flat, texts = [], [0], [], []
            for i, text in zip(batch.column(0).to_pylist(), text_list(batch.column(1)), strict=True):
                words = WORD.findall(text)
                if rewrite:
                    words = rewrite(i, words)
                runs = find_runs(word_ids(words), shortest, repeats)
                sizes.append(len(words))
                flat += runs
                ends.append(len(flat))
                texts.append(" ".join(collapse(words, runs)))
            parts = pa.StructArray.from_arrays([pa.array([r[k] for r in flat], pa.int64()) for k in range(3)], ["start", "length", "period"])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), parts), pa.array(texts, pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, SCHEMA)


def run_report(found: DataFrame) -> DataFrame:
    """Digest of :func:`periodic_runs`: the run of greatest exponent (ties: smallest start, then period) and checksums."""
    better = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    best = F.aggregate("runs", F.lit(None).cast("struct<start: long, length: long, period: long>"), lambda best, r: F.when(better(best, r), r).otherwise(best))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{k}").alias(k) for k in ("start", "length", "period")],
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
