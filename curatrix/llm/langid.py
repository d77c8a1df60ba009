"""Operator 12, language identification by segmentation-marginalised unigrams.

Pieces are those of a fixed public vocabulary of byte strings, which holds every single byte.  Each
language has a probability for every piece; the probability of a word (a run of letters, lower case,
behind a space) is the sum over all ways to cut it into pieces of the product of their probabilities,
which the forward algorithm gives: ``alpha[j] = sum over i of alpha[i] * p(word[i:j])``.  Words count as
independent, so a text's log probability is the sum of its words'; the language with the largest, with
its prior added, is predicted.

Fit: the words of all training documents are counted per language, within a task first, then over the
cluster.  Each of ``ROUNDS`` rounds of expectation-maximisation runs forward and backward over the
distinct (language, word) rows and sums the expected number of uses of each piece; what reaches the
driver is one number a piece and language at most.  Probabilities are smoothed by those of all languages
together.  The model that is broadcast has ``pieces x languages`` numbers, whatever the corpus: about
0.4 MB a language.  Words of more than ``LONGEST`` bytes teach nothing; they are scored whole like others.

The score is the posterior of the predicted language after the log probabilities are divided by the square root
of the number of words, as words of one text are far from independent; it orders predictions and is
rounded to six digits.

Defined results: a text that is null or has no letter gives ``und`` with score 0, and so does any text if
nothing was learned; a document with null lang or null id takes no part in the fit, and one with null id is
not held out; of equally likely languages the first by name is predicted; repeated rows count and are
predicted alike; other columns are ignored; very long texts are read whole; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batches, stored, text_list
from .shingles import U64, mix, powers

LETTERS = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"
ROUNDS = 2
#: Bytes of the longest word that takes part in the fit.
LONGEST = 64
#: Weight of the background distribution, in pieces, and of each piece in that.
PRIOR, FLOOR = 200.0, 0.05
#: Distinct words that a task counts before it hands them on, and that a worker remembers with their scores.
COUNTED, REMEMBERED = 200_000, 250_000
#: Bytes of words scored side by side.
SIDE = 1 << 17
_TINY, _BACK, _MOST = 1e-100, 1e100, 1e300
#: A factor exp(LIFT) for each byte keeps the sums of the fit in range.
LIFT = 2.5

_GROUPED = 40  # above the longest piece: places of hits are told by end * _GROUPED + length

_vocabularies: dict[str, "Vocabulary"] = {}


class Vocabulary:
    """Pieces, numbered in order, and where they are in words: told by 64-bit hashes of windows of bytes."""

    _rng = np.random.default_rng(20240307)
    BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
    BITS = 22

    def __init__(self, pieces: list[bytes]):
        self.size, self.longest = len(pieces), max(map(len, pieces))
        if self.longest >= _GROUPED:
            raise ValueError(f"pieces have to be shorter than {_GROUPED} bytes")
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
        hashes, lengths = np.zeros(self.size, U64), np.diff(ends, prepend=0)
        self._prepare(raw)
        for k in np.unique(lengths).tolist():
            own = np.flatnonzero(lengths == k)
            hashes[own] = self._hash(ends[own] - k, k)
        self.order = np.argsort(hashes)
        self.sorted = hashes[self.order]
        if (self.sorted[1:] == self.sorted[:-1]).any():
            raise ValueError("pieces are not distinct")
        # pieces whose hashes begin alike stand side by side: the first of each beginning, and how many there are at most
        heads = (self.sorted >> U64(64 - self.BITS)).astype(np.int64)
        self.first = np.full(1 << self.BITS, -1, np.int32)
        self.first[heads[::-1]] = np.arange(self.size - 1, -1, -1, dtype=np.int32)
        self.alike = int(np.bincount(heads).max())

    def _prepare(self, raw: np.ndarray) -> None:
        up, self._down = powers(len(raw) + 1)
        self._sums = np.zeros(len(raw) + 1, U64)
        np.cumsum(self.BYTE[raw] * up[: len(raw)], out=self._sums[1:])

    def _hash(self, at: np.ndarray, k: int) -> np.ndarray:
        return mix((self._sums[at + k] - self._sums[at]) * self._down[at] + U64(k))

    def hits(self, words: list[bytes]) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
        """All pieces in the words: (start, end, which words, their pieces), by end, then length; a word is once in each."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join(words), np.uint8)
        self._prepare(raw)
        ends = np.cumsum(sizes)
        owner = np.repeat(np.arange(len(words)), sizes)
        left = ends[owner] - np.arange(len(raw))
        at, keys, pieces, which = np.arange(len(raw)), [], [], []
        for k in range(1, min(self.longest, int(sizes.max())) + 1):
            at = at[left[at] >= k]
            h = self._hash(at, k)
            place = self.first[h >> U64(64 - self.BITS)]
            near = np.flatnonzero(place >= 0)
            place, h = place[near], h[near]
            for _ in range(self.alike - 1):
                place = np.minimum(place + (self.sorted[place] < h), self.size - 1)
            good = self.sorted[place] == h
            near, place = near[good], place[good]
            own = owner[at[near]]
            end = sizes[own] - left[at[near]] + k
            keys.append(end * _GROUPED + k)
            pieces.append(self.order[place])
            which.append(own)
        key = np.concatenate(keys)
        order = np.argsort(key.astype(np.uint16) if key.max() < 1 << 16 else key, kind="stable")
        key, piece, word = key[order], np.concatenate(pieces)[order], np.concatenate(which)[order]
        cuts = np.flatnonzero(np.diff(key, prepend=-1))
        return [(int(v // _GROUPED - v % _GROUPED), int(v // _GROUPED), word[lo:hi], piece[lo:hi]) for v, lo, hi in zip(key[cuts].tolist(), cuts, [*cuts[1:], len(key)], strict=True)]


def vocabulary(path: str) -> Vocabulary:
    """Pieces of a file of base64 pieces and ids, numbered in its order; read once by each worker."""
    if path not in _vocabularies:
        with open(path, "rb") as f:
            _vocabularies[path] = Vocabulary([base64.b64decode(line.split()[0]) for line in f])
    return _vocabularies[path]


def words_of(text: str) -> list[str]:
    """Lower-case runs of letters; none if no character is a letter."""
    words = LETTERS.findall(text.lower())
    return words if any(any(map(str.isalpha, w)) for w in words) else []


@dataclass(frozen=True)
class Model:
    """Names of the languages, logs of their priors, and probabilities: a row for each piece, a column for each language."""

    names: tuple[str, ...]
    priors: np.ndarray
    pieces: np.ndarray


def by_length(words: list[bytes]) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """Words of nearly the same length, of at most ``SIDE`` bytes together (or one word), with their places."""
    groups = defaultdict(list)
    for n, w in enumerate(words):
        groups[(len(w) - 1).bit_length()].append(n)
    for k, places in groups.items():
        step = max(1, SIDE >> k)
        for lo in range(0, len(places), step):
            part = places[lo : lo + step]
            yield np.array(part), [words[n] for n in part]


def log_probabilities(words: list[str], vocab: Vocabulary, pieces: np.ndarray) -> np.ndarray:
    """Logs of the words' probabilities, a column for each language, by the forward algorithm."""
    out = np.zeros((len(words), pieces.shape[1]))
    for places, part in by_length([b" " + w.encode() for w in words]):
        sizes = np.fromiter(map(len, part), np.int64, len(part))
        shift = np.zeros((len(part), pieces.shape[1]))
        alpha = np.zeros((int(sizes.max()) + 1, len(part), pieces.shape[1]))
        alpha[0] = 1.0
        done = 0
        for i, j, rows, ids in vocab.hits(part):
            if j > done:  # all sums up to ``done`` are complete; lift the small ones, and all that later sums still use with them
                if done % 8 == 0 and (low := (alpha[done] < _TINY) & (sizes >= done)[:, None]).any():
                    window = alpha[max(0, done - vocab.longest) : done + 1]
                    window[:, low] = np.minimum(window[:, low] * _BACK, _MOST)
                    shift[low] += np.log(_BACK)
                done = j
            alpha[j, rows] += alpha[i, rows] * pieces[ids]
        out[places] = np.log(np.maximum(alpha[sizes, np.arange(len(part))], 1e-300)) - shift
    return out


def expected_uses(words: list[bytes], lang: np.ndarray, count: np.ndarray, vocab: Vocabulary, pieces: np.ndarray) -> np.ndarray:
    """Expected uses of each piece (row) in each language (column), summed over the words' cuts."""
    size, languages = pieces.shape
    total = np.zeros(size * languages)
    flat = pieces.ravel()
    for places, part in by_length(words):
        which, times, sizes = lang[places], count[places], np.fromiter(map(len, part), np.int64, len(part))
        spans = [(i, j, rows, ids * languages + which[rows]) for i, j, rows, ids in vocab.hits(part)]
        weights = [flat[cells] * np.exp(LIFT * (j - i)) for i, j, _, cells in spans]
        alpha, beta = np.zeros((int(sizes.max()) + 1, len(part))), np.zeros((int(sizes.max()) + 1, len(part)))
        alpha[0] = beta[sizes, np.arange(len(part))] = 1.0
        for (i, j, rows, _), w in zip(spans, weights, strict=True):
            alpha[j, rows] += alpha[i, rows] * w
        for (i, j, rows, _), w in zip(reversed(spans), reversed(weights), strict=True):
            beta[i, rows] += beta[j, rows] * w
        share = times / np.maximum(alpha[sizes, np.arange(len(part))], 1e-300)
        uses = [alpha[i, rows] * w * beta[j, rows] * share[rows] for (i, j, rows, _), w in zip(spans, weights, strict=True)]
        total += np.bincount(np.concatenate([cells for *_, cells in spans]), np.concatenate(uses), len(total))
    return total.reshape(size, languages)


def held_out(id_col: str = "doc_id", folds: int = 4, fold: int = 2) -> Column:
    """Documents that take no part in the fit; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold, F.lit(False))


def counted_words(docs: DataFrame) -> DataFrame:
    """lang, word, n: how often each word is met in texts (text, lang)."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter[str]] = defaultdict(Counter)

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, counts in seen.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(counts), pa.string()), pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["lang", "word", "n"])
            seen.clear()

        for batch in batches(it):
            for text, lang in zip(text_list(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                seen[lang].update(words_of(text))
            if sum(map(len, seen.values())) > COUNTED:
                yield from flush()
        yield from flush()

    return docs.select("text", "lang").mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def smoothed(uses: np.ndarray) -> np.ndarray:
    """Probabilities of pieces from their uses; columns sum to one."""
    background = uses.sum(axis=1) + FLOOR
    background /= background.sum()
    return (uses + PRIOR * background[:, None]) / (uses.sum(axis=0) + PRIOR)


def fit(docs: DataFrame, path: str, text_col: str = "text", lang_col: str = "lang", rounds: int = ROUNDS) -> Model | None:
    """The model of all languages in ``docs``; None if there is no word to learn from."""
    spark = docs.sparkSession
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    words = stored(counted_words(rows.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))), "language-words")
    totals = dict(sorted((r["lang"], r["n"]) for r in words.groupBy("lang").agg(F.sum("n").alias("n")).collect()))  # a row for each language
    if not totals:
        return None
    names, size = tuple(totals), vocabulary(path).size
    pieces = np.full((size, len(names)), 1.0 / size)
    for _ in range(rounds):
        model = spark.sparkContext.broadcast(pieces)  # pieces x languages

        def run(it: Iterator[pa.RecordBatch], model=model) -> Iterator[pa.RecordBatch]:
            vocab, total, place = vocabulary(path), np.zeros((size, len(names))), {n: i for i, n in enumerate(names)}
            for batch in batches(it, 50_000):
                encoded = [b" " + w.encode() for w in batch.column("word").to_pylist()]
                short = [n for n, w in enumerate(encoded) if len(w) <= LONGEST]
                lang = np.array([place[x] for x in batch.column("lang").to_pylist()], np.int64)
                if short:
                    total += expected_uses([encoded[n] for n in short], lang[short], batch.column("n").to_numpy()[short].astype(float), vocab, model.value)
            piece, lang = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(piece.astype(np.int32)), pa.array(lang.astype(np.int32)), pa.array(total[piece, lang])], ["piece", "lang", "uses"])

        found = words.mapInArrow(run, "piece int, lang int, uses double").groupBy("piece", "lang").agg(F.sum("uses").alias("uses")).toArrow()
        uses = np.zeros_like(pieces)
        uses[found.column("piece").to_numpy(), found.column("lang").to_numpy()] = found.column("uses").to_numpy()
        pieces = smoothed(uses)
        model.destroy()
    counts = np.array([totals[n] for n in names], float)
    return Model(names, np.log(counts / counts.sum()), pieces)


class Scorer:
    """Log probabilities of words, those met before remembered."""

    def __init__(self, model: Model, path: str):
        self.model, self.vocab = model, vocabulary(path)
        self.place: dict[str, int] = {}
        self.logs = np.zeros((0, len(model.names)))

    def score(self, texts: list[str]) -> list[tuple[str, float]]:
        split = [words_of(t) for t in texts]
        new = list(set().union(*split) - self.place.keys())
        if len(self.place) + len(new) > REMEMBERED and self.place:
            self.place.clear()
            self.logs = self.logs[:0]
            new = list(set().union(*split))
        self.logs = np.concatenate([self.logs, log_probabilities(new, self.vocab, self.model.pieces)])
        self.place.update(zip(new, range(len(self.place), len(self.place) + len(new)), strict=True))
        return [self._verdict(words) for words in split]

    def _verdict(self, words: list[str]) -> tuple[str, float]:
        if not words:
            return UNKNOWN, 0.0
        logs = self.logs[np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))].sum(axis=0) + self.model.priors
        best = int(logs.argmax())
        return self.model.names[best], round(float(1.0 / np.exp((logs - logs[best]) / np.sqrt(len(words))).sum()), 6)


def languages(docs: DataFrame, path: str, folds: int = 4, fold: int = 2, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document, learned from those that are not held out."""
    spark = docs.sparkSession
    kept_back = held_out(id_col, folds, fold)
    model = fit(docs.where(F.col(id_col).isNotNull() & ~kept_back), path, text_col, lang_col)
    shared = spark.sparkContext.broadcast(model)  # pieces x languages

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value, path) if shared.value else None
        for batch in batches(it):
            texts = text_list(batch.column(2))
            found = scorer.score(texts) if scorer else [(UNKNOWN, 0.0)] * len(texts)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), kept_back.alias("held_out"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
