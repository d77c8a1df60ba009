"""Operator 10, quality rules with risk-controlled thresholds.

Each rule is a ratio of a document's counts, put into one of ``GRID`` + 1 buckets; a cutoff rejects
buckets from it upward.  Labelled documents that pass the fixed base rules are dealt in two halves by a
hash of their id.  In each stratum the first half lays down a path: step after step one rule's cutoff
is lowered, always where it rejects most bad documents for the good ones it costs, so each step rejects
all that the steps before it do.  The second half is the holdout: a step is certified when the exact
binomial (Clopper-Pearson) upper bound on the rate of good documents that its rules *together* reject is
at most ``risk``.  Steps are tested in the order of the path until the first failure, which needs no
correction within a stratum; strata share ``delta`` by Holm's method, a stratum whose whole path is
certified passing its share on.  With probability 1 - ``delta`` at least, in no stratum more than
``risk`` of good documents are rejected.  Of the certified steps the one with most rejected bad
documents less ``PRICE`` times the good ones in the holdout is taken, the earliest of equals; none if
none gains.  Only histograms go to the driver: strata x rules x buckets x 2 counts, and strata x steps
x 2, at most.

Defined results: null or empty text has no words and fails the base; a null or unlisted language
belongs to stratum "other"; documents without label, with null label or null doc_id take no part in
the fit; of several labels of one doc_id the lowest quality counts; no labels: only the base
rejects; repeated rows are judged alike; other columns are kept by :func:`quality_filter` and
ignored by :func:`quality_report`; very long texts are measured whole; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import batches, stored, text_list

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Rules: what is counted, for each word or line, on a scale from 0 to 1.
RULES = ("repeated words", "symbols", "repeated lines", "capital words", "commonest word", "long words")
GRID = 100
#: Bad documents that a rejected good one must be worth, and that a step of a path must reject at least.
PRICE, LEAST = 10, 3
STRATA = ("en", "de", "fr", "es")


@dataclass(frozen=True)
class Thresholds:
    """Cutoff bucket of each (stratum, rule) in use, and what it did to the holdout."""

    cutoffs: dict[tuple[str, int], int] = field(default_factory=dict)
    report: tuple = ()

    def rejects(self, stratum: str, buckets: list[int]) -> bool:
        return any(b >= self.cutoffs.get((stratum, r), GRID + 1) for r, b in enumerate(buckets))


def stratum_of(lang: str | None) -> str:
    return lang if lang in STRATA else "other"


def measure(text: str) -> tuple[list[int], list[int]]:
    """The contract's counts, and the bucket of each rule."""
    words = WORD.findall(text)
    n = len(words)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = list(zip(words, words[1:], words[2:], strict=False))
    repeated = 0
    if len(set(grams)) < len(grams):
        often = Counter(grams)
        until = 0
        for i, g in enumerate(grams):
            if often[g] > 1:
                repeated += i + 3 - max(i, until)
                until = i + 3
    symbols = sum(map(text.count, SYMBOLS))
    chars = sum(map(len, words))
    dup = len(lines) - len(set(lines))
    counts = [n, chars, symbols, dup, repeated]
    if not n:
        return counts, [0] * len(RULES)
    capital = sum(map(str.isupper, words))
    common = max(Counter(words).values())
    ratios = (repeated / n, symbols / n, dup / max(1, len(lines)), capital / n, common / n, chars / n / 50)
    return counts, [min(GRID, int(GRID * x)) for x in ratios]


def base_failed(counts: list[int]) -> bool:
    return counts[0] < 50 or 100 * counts[4] > 50 * counts[0]


def binomial_cdf(k: int, n: int, p: float) -> float:
    """P(X <= k) of X ~ Bin(n, p), summed from its largest term down; for k below the mean."""
    if k >= n:
        return 1.0
    log_term = math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    total = ratio = 1.0
    for i in range(k, 0, -1):
        ratio *= i * (1 - p) / ((n - i + 1) * p)
        total += ratio
        if ratio < 1e-18 * total:
            break
    return min(1.0, math.exp(log_term) * total)


def certified(rejected: int, good: int, risk: float, delta: float) -> bool:
    """The exact upper confidence bound on the rate of ``rejected`` of ``good`` is at most ``risk``."""
    return good > 0 and rejected < risk * good and binomial_cdf(rejected, good, risk) <= delta


def path(histogram: dict[tuple[int, int, int], int]) -> list[tuple[int, int]]:
    """Steps (rule, cutoff) that lower cutoffs, from counts of (rule, bucket, quality) of one stratum.

    Each takes the rule and cutoff with most bad documents for each good one (and a half) between the
    new cutoff and the last.
    """
    count = [[[histogram.get((rule, b, q), 0) for b in range(GRID + 1)] for q in (0, 1)] for rule in range(len(RULES))]
    cutoffs, out = [GRID + 1] * len(RULES), []
    while True:
        best = None
        for rule, (bad, good) in enumerate(count):
            n_bad = n_good = 0
            for cut in range(cutoffs[rule] - 1, 0, -1):
                n_bad += bad[cut]
                n_good += good[cut]
                if n_bad >= LEAST and n_bad > PRICE * n_good and bad[cut]:
                    rank = (n_bad / (n_good + 0.5), -rule, cut)
                    if best is None or rank > best[0]:
                        best = (rank, rule, cut)
        if best is None:
            return out
        _, rule, cut = best
        cutoffs[rule] = cut
        out.append((rule, cut))


def steps_of(steps: list[tuple[int, int]]) -> list[list[int]]:
    """For each rule and bucket the first step that rejects it; the number of steps if none does."""
    table = [[len(steps)] * (GRID + 1) for _ in RULES]
    for i, (rule, cut) in reversed(list(enumerate(steps))):
        table[rule][cut:] = [i] * (GRID + 1 - cut)
    return table


def choose(paths: dict[str, list[tuple[int, int]]], counts: dict[tuple[str, int, int], int], risk: float, delta: float) -> Thresholds:
    """Cutoffs from each stratum's path and the holdout's counts of (stratum, first rejecting step, quality)."""
    open_paths = {s for s, steps in paths.items() if steps}
    passed = dict.fromkeys(paths, 0)
    rejected, good = {}, {}
    for s, steps in paths.items():
        rejected[s] = [[sum(counts.get((s, j, q), 0) for j in range(i + 1)) for i in range(len(steps))] for q in (0, 1)]
        good[s] = sum(counts.get((s, j, 1), 0) for j in range(len(steps) + 1))
    while open_paths:
        share = delta / len(open_paths)
        for s in open_paths:
            while passed[s] < len(paths[s]) and certified(rejected[s][1][passed[s]], good[s], risk, share):
                passed[s] += 1
        done = {s for s in open_paths if passed[s] == len(paths[s])}
        if not done:
            break
        open_paths -= done
    cutoffs, report = {}, []
    for s, steps in paths.items():
        gains = [rejected[s][0][i] - PRICE * rejected[s][1][i] for i in range(passed[s])]
        if gains and max(gains) > 0:
            last = gains.index(max(gains))
            for rule, cut in steps[: last + 1]:
                cutoffs[(s, rule)] = cut
            report.append((s, last + 1, len(steps), rejected[s][1][last], good[s], rejected[s][0][last]))
    return Thresholds(cutoffs, tuple(report))


STATS = "doc_id long, stratum string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, buckets array<int>"


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Counts and buckets of every document, without its text."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it):
            found = [measure(t) for t in text_list(batch.column(1))]
            columns = [batch.column(0), pa.array([stratum_of(x) for x in batch.column(2).to_pylist()], pa.string())]
            columns += [pa.array([c[i] for c, _ in found], pa.int64()) for i in range(len(COUNTS))]
            columns += [pa.array([base_failed(c) for c, _ in found], pa.bool_()), pa.array([b for _, b in found], pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "stratum", *COUNTS, "base_failed", "buckets"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    return rows.mapInArrow(run, STATS)


def fit(stats: DataFrame, labels: DataFrame, risk: float = 0.05, delta: float = 0.05) -> Thresholds:
    """Risk-controlled thresholds from labelled documents' stats."""
    marks = labels.where("doc_id is not null and quality in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality"))
    # the holdout is told by the id; the stats of labelled documents are written, as both halves need them
    half = (F.pmod(F.xxhash64("doc_id", F.lit("holdout")), F.lit(2)) == 1).alias("holdout")
    held = stored(stats.where(~F.col("base_failed")).select("doc_id", "stratum", "buckets").join(marks, "doc_id").select("stratum", "quality", "buckets", half), "labelled-quality")
    rows = held.where("not holdout").select("stratum", "quality", F.posexplode("buckets").alias("rule", "bucket")).groupBy("stratum", "rule", "bucket", "quality").count().collect()
    paths = {s: path({(r["rule"], r["bucket"], r["quality"]): r["count"] for r in rows if r["stratum"] == s}) for s in (*STRATA, "other")}
    step = F.lit(None).cast("int")
    for s, steps in paths.items():
        if steps:
            firsts = [F.array(*[F.lit(x) for x in table])[F.col("buckets")[rule]] for rule, table in enumerate(steps_of(steps))]
            step = F.when(F.col("stratum") == s, F.least(*firsts)).otherwise(step)
    counted = held.where("holdout").select("stratum", step.alias("step"), "quality").where("step is not null").groupBy("stratum", "step", "quality").count().collect()
    return choose(paths, {(r["stratum"], r["step"], r["quality"]): r["count"] for r in counted}, risk, delta)


def rejected(limits: Thresholds, stratum: str = "stratum", buckets: str = "buckets") -> Column:
    """The verdict of the cutoffs."""
    out = F.lit(False)
    for (s, rule), cut in limits.cutoffs.items():
        out = out | ((F.col(stratum) == s) & (F.col(buckets)[rule] >= cut))
    return out


def quality_report(docs: DataFrame, labels: DataFrame, risk: float = 0.05, delta: float = 0.05) -> DataFrame:
    """A row for each document: its counts, whether the base fails it, and the verdict."""
    stats = stored(measured(docs), "quality")
    limits = fit(stats, labels, risk, delta)
    return stats.select("doc_id", *COUNTS, "base_failed", (~F.col("base_failed") & ~rejected(limits)).alias("kept"))


def quality_filter(docs: DataFrame, labels: DataFrame, risk: float = 0.05, delta: float = 0.05) -> DataFrame:
    """The documents that are kept, with all their columns.

    Texts are measured once: those that the base lets through are written with their buckets.
    """
    extra = "__curatrix_quality"
    kind = T.StructType([T.StructField("stratum", T.StringType()), T.StructField("buckets", T.ArrayType(T.IntegerType()))])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it):
            found = [measure(t) for t in text_list(batch.column("text"))]
            marks = [{"stratum": stratum_of(x), "buckets": b} for x, (_, b) in zip(batch.column("lang").to_pylist(), found, strict=True)]
            wide = pa.RecordBatch.from_arrays([*batch.columns, pa.array(marks, pa.struct([("stratum", pa.string()), ("buckets", pa.list_(pa.int32()))]))], [*batch.schema.names, extra])
            yield wide.filter(pa.array([not base_failed(counts) for counts, _ in found], pa.bool_()))

    passed = stored(docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(extra, kind)])), "quality")
    stats = passed.select(F.col("doc_id").cast("long").alias("doc_id"), f"{extra}.stratum", f"{extra}.buckets", F.lit(False).alias("base_failed"))
    limits = fit(stats, labels, risk, delta)
    return passed.where(~rejected(limits, f"{extra}.stratum", f"{extra}.buckets")).select(*docs.columns)
