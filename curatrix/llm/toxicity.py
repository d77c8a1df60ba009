"""Operator 3, toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max index.

Examples are labelled training documents, at most ``max_examples`` of each label and EXAMPLE_CHARS
characters of text, taken in the order of a hash.  The vocabulary is every term of theirs that at least
MIN_DOCUMENTS documents hold, whatever its label; document frequencies are counted over all documents.
Documents and examples are vectors of (1 + ln tf) x IDF x emphasis of the term.  The emphasis is
1 + EMPHASIS x the lower confidence bound of the term's log odds between the labels: 1 for all terms that
chance could explain.  Plain IDF (``emphasis`` = 0) ranks by rare words of any kind and loses two toxic
documents of five; the README has both figures.

The index keeps a dense matrix of the HEAD commonest terms, and for each other term and each block of BLOCK examples, the largest weight and where the block's
postings begin; a query sums the
former, on the largest product of a block with the dense part, into an upper bound for each block, visits blocks in falling order
of bounds, and stops when no bound can enter the nearest k any more, so the k nearest are exact.  Their
votes, weighted by cosine and by what each example stands for among all labelled training documents,
become a probability by isotonic regression on votes that are out of fold: neither the index nor the
emphasis of the terms has seen the example.

Only the index travels to the executors: at most 2 x EXAMPLE_CHARS characters of examples and 12 bytes for
each of their postings.

Defined results: null, empty and unrelated texts have no vector and get the rate of toxic documents among
the labelled ones; no usable labels: score 0; documents in several labels count as toxic if any says so;
of rows that repeat an example's doc_id one text teaches; null labels or doc_ids teach nothing; equal texts
get equal scores; ties between neighbours go to the smaller example number; long texts are read whole; an
empty table gives no rows; other columns are ignored (or kept, by the filter).
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, stored, text_list

TERM = re.compile(r"\w+")
FOLDS = 5
MAX_EXAMPLES = 1000
#: Characters of text of each label's examples at most.
EXAMPLE_CHARS = 8_000_000
MIN_DOCUMENTS = 2
NEAREST = 25
BLOCK = 64
#: Blocks that are visited before the bounds are looked at again.
ROUND = 6
#: Terms with the longest postings, which are kept as a dense matrix; documents multiplied with it at a time.
HEAD, BATCH = 256, 128
EMPHASIS = 4.0
#: Standard scores of the confidence bound: of a hundred thousand terms a few reach it by chance.
SURE = 4.0
#: Folds of the examples for votes out of fold.
PARTS = 4


def held_out(id_col: str = "doc_id"):
    """Rows whose crc32 of the id as text is divisible by FOLDS teach nothing."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def terms(text: str) -> list[str]:
    return TERM.findall(text.lower())


def spans(first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All numbers of the ranges first to end, one range behind the other."""
    sizes = end - first
    before = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) + np.repeat(first - before, sizes)


def evidence(toxic: np.ndarray, both: np.ndarray, share: float) -> np.ndarray:
    """Lower confidence bounds of the terms' log odds between the labels, 0 if chance may explain them.

    Wilson bounds at SURE of the share of toxic documents among those with the term, against the share among all.
    """
    n, z = both, SURE * SURE
    p = toxic / n
    middle, half = (p + z / (2 * n)) / (1 + z / n), SURE / (1 + z / n) * np.sqrt(p * (1 - p) / n + z / (4 * n * n))
    logit = lambda x: np.log(x / (1 - x))
    low, high = np.clip(middle - half, 1e-12, 1 - 1e-12), np.clip(middle + half, 1e-12, 1 - 1e-12)
    return np.maximum(0, np.maximum(logit(low) - logit(share), logit(share) - logit(high)))


#: A term in a block: the largest weight there, its first posting and how many it has.
ENTRY = np.dtype([("most", "f8"), ("first", "i8"), ("block", "i4"), ("size", "i4")])
POSTING = np.dtype([("value", "f8"), ("example", "i8")])


@dataclass
class Index:
    """Block-max inverted index of examples, and the calibration of their votes."""

    number: dict[str, int]
    weight: np.ndarray  # of each term
    ids: np.ndarray  # the examples' doc_ids
    toxic: np.ndarray
    mass: np.ndarray  # labelled documents that each example stands for
    begin: np.ndarray  # first entry of each term, and the end
    entries: np.ndarray  # ENTRY, by term and block
    postings: np.ndarray  # POSTING, by term and example
    head: np.ndarray  # examples x the HEAD commonest terms, which are numbered first
    home: np.ndarray  # block of each example
    rate: float
    knots: tuple[np.ndarray, np.ndarray]  # votes, probabilities

    def vector(self, counts: Counter) -> tuple[np.ndarray, np.ndarray]:
        """Term numbers and unit weights of counted terms."""
        n = len(counts)
        at = np.fromiter(map(self.number.get, counts, repeat(-1, n)), np.int64, n)
        tf = np.fromiter(counts.values(), float, n)[at >= 0]
        at = at[at >= 0]
        if not len(at):
            return at, tf
        order = np.argsort(at)
        at, w = at[order], (1 + np.log(tf[order])) * self.weight[at[order]]
        return at, w / np.linalg.norm(w)

    def nearest(self, at: np.ndarray, w: np.ndarray, head: np.ndarray, head_most: np.ndarray, k: int = NEAREST) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of largest positive cosine, exactly.

        ``head`` has the products with the examples over the first terms, ``head_most`` the largest of each block.
        """
        cut = np.searchsorted(at, self.head.shape[1])
        at, w = at[cut:], w[cut:]
        begin, end = self.begin[at], self.begin[at + 1]
        entry = self.entries[spans(begin, end)]
        q, of = np.repeat(w, end - begin), entry["block"]
        bound = head_most + np.bincount(of, q * entry["most"], minlength=len(head_most))
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        best, values = np.zeros(0, np.int64), np.zeros(0)
        for size in (ROUND, len(order)):
            if len(values) == k:
                order = order[bound[order] >= values[-1] - 1e-11]  # sums are rounded
            if not len(order):
                break
            now = np.zeros(len(bound), bool)
            now[order[:size]] = True
            order = order[size:]
            use = now[of]
            first, n = entry["first"][use], entry["size"][use]
            posts = self.postings[spans(first, first + n)]
            rest = np.bincount(posts["example"], np.repeat(q[use], n) * posts["value"], minlength=len(head))
            scores = np.where(now[self.home], head + rest, 0)
            hits = np.flatnonzero(scores > (values[-1] - 1e-11 if len(values) == k else 0))
            best, values = np.concatenate([best, hits]), np.concatenate([values, scores[hits].round(12)])
            top = np.lexsort((best, -values))[:k]
            best, values = best[top], values[top]
        return best, values

    def vote(self, found: np.ndarray, cosines: np.ndarray) -> float:
        power = cosines * self.mass[found]
        return float(power @ self.toxic[found] / power.sum())

    def judge(self, many: list[Counter]) -> list[tuple[float | None, np.ndarray]]:
        """The vote of each document, None without neighbours, and its nearest examples."""
        out: list[tuple[float | None, np.ndarray]] = []
        edges = np.arange(0, len(self.ids), BLOCK)
        for lo in range(0, len(many), BATCH):
            vectors = [self.vector(counts) for counts in many[lo : lo + BATCH]]
            first = np.zeros((len(vectors), self.head.shape[1]))
            for row, (at, w) in zip(first, vectors, strict=True):
                cut = np.searchsorted(at, len(row))
                row[at[:cut]] = w[:cut]
            head = first @ self.head.T
            most = np.maximum.reduceat(head, edges, axis=1)
            for (at, w), x, y in zip(vectors, head, most, strict=True):
                found, cosines = self.nearest(at, w, x, y) if len(at) else (at, w)
                out.append((self.vote(found, cosines) if len(found) else None, found))
        return out

    def scores(self, texts: list[str]) -> list[tuple[float, np.ndarray]]:
        """Each text's score and the ids of its nearest examples."""
        # isotonic steps are flat; a thousandth of the vote keeps the order within a step
        return [
            (self.rate if vote is None else float(0.999 * np.interp(vote, *self.knots) + 0.001 * vote), self.ids[found[:5]])
            for vote, found in self.judge([Counter(terms(t)) for t in texts])
        ]


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the weighted isotonic regression of y on x, by pooling adjacent violators."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []  # mean, weight, first x, last x
    for a, b, c in zip(x[order].tolist(), y[order].tolist(), w[order].tolist(), strict=True):
        pools.append([b, c, a, a])
        while len(pools) > 1 and (pools[-2][0] >= pools[-1][0] or pools[-2][3] == pools[-1][2]):
            m, v, _, last = pools.pop()
            p = pools[-1]
            p[0] = (p[0] * p[1] + m * v) / (p[1] + v)
            p[1] += v
            p[3] = last
    xs = [z for p in pools for z in (p[2], p[3])]
    ys = [p[0] for p in pools for _ in (0, 1)]
    return np.array(xs), np.array(ys)


def make(examples: list[tuple[int, int, Counter]], documents: dict[str, int], total: int, mass: tuple[float, float], emphasis: float) -> Index:
    """An uncalibrated index of (doc_id, toxic, counts of terms) of each example."""
    held = Counter(t for _, _, counts in examples for t in counts)
    names = sorted((t for t in held if documents.get(t, 0) >= MIN_DOCUMENTS), key=lambda t: (-held[t], t))
    number = {t: i for i, t in enumerate(names)}
    both, toxic = np.zeros(len(names)), np.zeros(len(names))
    rows = []
    for key, label, counts in examples:
        found = sorted((number[t], c) for t, c in counts.items() if t in number)
        at, tf = np.array(found, np.int64).T if found else np.zeros((2, 0), np.int64)
        both[at] += 1
        toxic[at] += label
        rows.append((key, label, at, tf))
    share = sum(r[1] for r in rows) / len(rows)
    idf = np.log1p(total / np.array([documents[t] for t in names], float)) if names else np.zeros(0)
    weight = idf * (1 + emphasis * evidence(toxic, both, share)) if 0 < share < 1 and names else idf
    vectors = []
    for key, label, at, tf in rows:
        w = (1 + np.log(tf)) * weight[at] if len(at) else np.zeros(0)
        vectors.append((key, label, at, w / np.linalg.norm(w) if len(w) else w))
    # examples of one language (its commonest terms), then of the same weighty terms, stand together, which keeps the block maxima tight
    common = lambda at: int(at[np.argmin(idf[at])]) if len(at) else -1
    vectors.sort(key=lambda v: (tuple(v[2][np.argsort(-v[3], kind="stable")[:1]].tolist()) if len(v[2]) and v[3].max() > 0.3 else (-1,), common(v[2]), tuple(v[2][np.argsort(-v[3], kind="stable")[:3]].tolist()), v[0]))
    n = len(vectors)
    sizes = [len(v[2]) for v in vectors]
    term = np.concatenate([v[2] for v in vectors]) if n else np.zeros(0, np.int64)
    value = np.concatenate([v[3] for v in vectors]) if n else np.zeros(0)
    example = np.repeat(np.arange(n), sizes)
    order = np.lexsort((example, term))
    term, value, example = term[order], value[order], example[order]
    in_head = term < HEAD
    head = np.zeros((n, min(HEAD, len(names))))
    head[example[in_head], term[in_head]] = value[in_head]
    term, value, example = term[~in_head], value[~in_head], example[~in_head]
    block = example // BLOCK
    start = np.flatnonzero(np.concatenate([[True], (term[1:] != term[:-1]) | (block[1:] != block[:-1])])) if len(term) else np.zeros(0, np.int64)
    entries, postings = np.zeros(len(start), ENTRY), np.zeros(len(term), POSTING)
    if len(start):
        entries["most"], entries["first"], entries["block"] = np.maximum.reduceat(value, start), start, block[start]
        entries["size"] = np.diff(np.append(start, len(term)))
        postings["value"], postings["example"] = value, example
    labels = np.array([v[1] for v in vectors], float)
    masses = np.array([mass[v[1]] for v in vectors])
    return Index(
        number, weight, np.array([v[0] for v in vectors], np.int64), labels, masses, np.searchsorted(term[start], np.arange(len(names) + 1)), entries, postings,
        head, np.arange(n) // BLOCK, float(masses @ labels / masses.sum()), (np.array([0.0, 1.0]), np.array([0.0, 1.0])),
    )


def build(examples: list[tuple[int, int, Counter]], documents: dict[str, int], total: int, mass: tuple[float, float] = (1.0, 1.0), emphasis: float = EMPHASIS) -> Index:
    """An index whose votes are calibrated out of fold; ``documents`` of ``total`` hold each term."""
    index = make(examples, documents, total, mass, emphasis)
    votes, truth, power = [], [], []
    for part in range(PARTS):
        rest = [e for i, e in enumerate(examples) if i % PARTS != part]
        if not rest:
            continue
        other = make(rest, documents, total, mass, emphasis)
        for (_, label, _), (vote, _) in zip(examples[part::PARTS], other.judge([e[2] for e in examples[part::PARTS]]), strict=True):
            if vote is not None:
                votes.append(vote)
                truth.append(label)
                power.append(mass[label])
    if votes:
        index.knots = isotonic(np.array(votes), np.array(truth, float), np.array(power))
    return index


def fit(docs: DataFrame, labels: DataFrame, max_examples: int = MAX_EXAMPLES, emphasis: float = EMPHASIS) -> Index | None:
    """Learn from labelled documents outside the held-out fold; None if a label is missing."""
    marks = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    totals = {r["toxic"]: r["count"] for r in marks.groupBy("toxic").count().collect()}
    if not totals.get(0) or not totals.get(1):
        return None
    picked = None
    for label in (0, 1):
        part = marks.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_examples)
        picked = part if picked is None else picked.unionByName(part)
    spark = docs.sparkSession
    # 2 x max_examples rows at most
    small = spark.createDataFrame([(r["doc_id"], r["toxic"]) for r in picked.collect()], "doc_id long, toxic int")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(small), "doc_id")
    texts = stored(rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min_by("text", F.xxhash64("text")).alias("text")), "examples")
    room = {0: EXAMPLE_CHARS, 1: EXAMPLE_CHARS}
    chosen = []
    for r in sorted(texts.select("doc_id", "toxic", F.length("text").alias("n"), F.xxhash64("doc_id").alias("h")).collect(), key=lambda r: (r["h"], r["doc_id"])):
        if r["n"] <= room[r["toxic"]]:
            room[r["toxic"]] -= r["n"]
            chosen.append(r["doc_id"])
    keep = spark.createDataFrame([(k,) for k in chosen], "doc_id long")
    place = {k: i for i, k in enumerate(chosen)}
    # at most EXAMPLE_CHARS characters of each label
    examples = [(r["doc_id"], r["toxic"], Counter(terms(r["text"]))) for r in sorted(texts.join(F.broadcast(keep), "doc_id").collect(), key=lambda r: place[r["doc_id"]])]
    shown = Counter(e[1] for e in examples)
    if not shown[0] or not shown[1]:
        return None
    names = sorted({t for _, _, counts in examples for t in counts})
    shared = spark.sparkContext.broadcast({t: i for i, t in enumerate(names)})

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents that hold each of the examples' terms, in this partition."""
        held, get = np.zeros(len(shared.value) + 1, np.int64), shared.value.get
        for batch in batches(it):
            for text in text_list(batch.column(0)):
                mine = set(map(get, set(terms(text))))
                mine.discard(None)
                held[np.fromiter(mine, np.int64, len(mine))] += 1
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(held[some])], ["term", "n"])

    # counted over all documents, aggregated before the shuffle
    counted = docs.select("text").mapInArrow(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    documents = {names[r["term"]]: r["n"] for r in counted.collect()}  # the examples' terms
    shared.unpersist()
    return build(examples, documents, docs.count(), (totals[0] / shown[0], totals[1] / shown[1]), emphasis)


def toxicity_scores(docs: DataFrame, labels: DataFrame, max_examples: int = MAX_EXAMPLES, emphasis: float = EMPHASIS) -> DataFrame:
    """A row for each document: doc_id, held_out, score, predicted, and the nearest examples' ids."""
    index = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, max_examples, emphasis))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it):
            texts = text_list(batch.column("text"))
            found = index.value.scores(texts) if index.value else [(0.0, [])] * len(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array([s for s, _ in found], pa.float64()), pa.array([int(s >= 0.5) for s, _ in found], pa.int32()), pa.array([list(e) for _, e in found], pa.list_(pa.int64()))],
                ["doc_id", "held_out", "score", "predicted", "nearest"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int, nearest array<long>")


def toxicity_filter(docs: DataFrame, labels: DataFrame, max_examples: int = MAX_EXAMPLES, emphasis: float = EMPHASIS) -> DataFrame:
    """The documents that score below 0.5, with all their columns."""
    index = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, max_examples, emphasis))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it):
            yield batch.filter(pa.array([s < 0.5 for s, _ in index.value.scores(text_list(batch.column("text")))], pa.bool_())) if index.value else batch

    return docs.mapInArrow(run, docs.schema)
