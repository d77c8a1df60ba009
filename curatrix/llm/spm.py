"""Operator 1, SentencePiece encoding and decoding by streaming Viterbi.

The encoder walks over normalised characters and keeps, for every boundary, a backpointer to the
best piece that ends there.  Future pieces can only begin at the last ``longest piece`` boundaries;
the paths back from these are followed until they meet, and ids up to the meeting boundary are
committed and forgotten.  What is retained is a window of the longest piece and the stretch that is
not settled yet, whatever the length of the text.

Models of type unigram are decoded by the largest sum of scores.  In models of type BPE scores are
merge ranks and a sum of them means nothing; there a path is admissible if every two neighbouring
pieces are what the merge rule makes of their joined text, which leaves exactly one admissible piece
at each boundary, the last of the merge rule's own segmentation of the text so far.  Either way the ids are those
of the SentencePiece library for the same file.

If no piece of the vocabulary holds the space mark behind another character, all paths meet in front
of every space, so words settle on their own and frequent ones are remembered (a bounded memo).

Defined results: null and empty texts have no ids; unknown characters become byte pieces where the
model has them, otherwise one <unk> for a run; decoding undoes the space mark and the dummy prefix, so the
mark itself (U+2581) in a text reads back as a space; other columns are ignored.
"""

from __future__ import annotations

import struct
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, crc_u32, text_list

MARK = "▁"
#: Words remembered by each Python worker.
MEMO_WORDS = 600_000
#: Boundaries between two looks at where paths meet.
SETTLE_EVERY = 64
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protocol-buffer message."""
    at, n = 0, len(data)

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            if b < 128:
                return value
            shift += 7

    while at < n:
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
        elif tag & 7 == 1:
            yield tag >> 3, data[at : at + 8]
            at += 8
        elif tag & 7 == 2:
            size = varint()
            yield tag >> 3, data[at : at + size]
            at += size
        else:
            yield tag >> 3, data[at : at + 4]
            at += 4


class Model:
    """Pieces, scores and settings of a SentencePiece model file."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            data = f.read()
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.types: list[int] = []
        self.kind, self.dummy_prefix, self.squeeze, self.escape, charsmap = UNIGRAM, True, True, True, b""
        for number, value in _fields(data):
            if number == 1:
                piece, score, kind = "", 0.0, NORMAL
                for k, v in _fields(value):
                    if k == 1:
                        piece = v.decode()
                    elif k == 2:
                        (score,) = struct.unpack("<f", v)
                    elif k == 3:
                        kind = v
                self.pieces.append(piece)
                self.scores.append(score)
                self.types.append(kind)
            elif number == 2:
                self.kind = dict(x for x in _fields(value) if x[0] == 3).get(3, UNIGRAM)
            elif number == 3:
                settings = dict(_fields(value))
                charsmap = settings.get(2, b"")
                self.dummy_prefix, self.squeeze, self.escape = (bool(settings.get(k, 1)) for k in (3, 4, 5))
        if charsmap or self.squeeze or not self.escape or self.kind not in (UNIGRAM, BPE):
            raise ValueError("only models with identity normalisation and kept spaces, of type unigram or BPE, are supported")
        if USER in self.types:
            raise ValueError("models with user-defined symbols are not supported")
        self.ids = {p: i for i, (p, t) in enumerate(zip(self.pieces, self.types, strict=True)) if t == NORMAL}
        self.unknown = self.types.index(UNKNOWN)
        self.bytes = {int(p[3:5], 16): i for i, (p, t) in enumerate(zip(self.pieces, self.types, strict=True)) if t == BYTE}
        self.longest = max(map(len, self.ids))
        self.words_settle = not any(MARK in p.lstrip(MARK) for p in self.ids)
        self.newline_settles = not any("\n" in p and len(p) > 1 for p in self.ids)
        normal = [self.scores[i] for i in self.ids.values()]
        self.unknown_score = min(normal) - 10.0


class StreamingViterbi:
    """Encodes a normalised text that comes in pieces: ``push`` and ``finish`` give committed ids.

    ``window`` tells how many boundaries are retained at most so far.
    """

    def __init__(self, model: Model, pairs: PairRule | None = None):
        self.model = model
        self.rule = pairs or (PairRule(model) if model.kind == BPE else None)
        self.window = 0
        self._start()

    def _start(self) -> None:
        self.text = ""  # characters from the last committed boundary on
        self.last = [-1]  # id of the best piece ending at each boundary; -1: none or an unknown character
        self.back = [0]  # where it begins
        self.value = [0.0]
        self.before = -1  # the piece that ends at the committed boundary

    def push(self, text: str) -> list[int]:
        out: list[int] = []
        for lo in range(0, len(text), SETTLE_EVERY):
            self._walk(text[lo : lo + SETTLE_EVERY])
            self.window = max(self.window, len(self.last))
            if len(self.last) > 2 * self.model.longest:
                out += self._commit(self._meeting())
        return out

    def finish(self) -> list[int]:
        out = self._commit(len(self.text))
        self._start()
        return out

    def settled(self, s: str) -> list[int]:
        """Ids of a short text at both ends of which all paths meet: one walk, one way back."""
        if not self.rule or len(s) > SETTLE_EVERY:
            return self.push(s) + self.finish()
        get, longest, known, fits = self.model.ids.get, self.model.longest, self.rule.known.get, self.rule.fits
        last, back = [-1], [0]
        for i in range(1, len(s) + 1):
            found, at = -1, i - 1
            for j in range(i - longest if i > longest else 0, i):
                t = get(s[j:i])
                if t is not None:
                    before = last[j]
                    if before >= 0:
                        fit = known(before << 24 | t)
                        if not (fits(before, t) if fit is None else fit):
                            continue
                    found, at = t, j
                    break
            last.append(found)
            back.append(at)
        out: list[int] = []
        i = len(s)
        while i:
            t = last[i]
            if t >= 0:
                out.append(t)
            elif self.model.bytes:
                out += [self.model.bytes[b] for b in reversed(s[back[i] : i].encode())]
            elif not out or out[-1] != self.model.unknown:
                out.append(self.model.unknown)
            i = back[i]
        out.reverse()
        return out

    def _walk(self, text: str) -> None:
        self.text += text
        s, get, longest = self.text, self.model.ids.get, self.model.longest
        last, back, value = self.last, self.back, self.value
        if self.rule:
            fits = self.rule.fits
            for i in range(len(last), len(s) + 1):
                found, at = -1, i - 1
                for j in range(max(0, i - longest), i):
                    t = get(s[j:i])
                    if t is not None:
                        before = last[j] if j else self.before
                        if before < 0 or fits(before, t):
                            found, at = t, j
                            break
                last.append(found)
                back.append(at)
                value.append(0.0)
        else:
            scores, worst = self.model.scores, self.model.unknown_score
            for i in range(len(last), len(s) + 1):
                best, found, at = value[i - 1] + worst, -1, i - 1
                for j in range(max(0, i - longest), i):
                    t = get(s[j:i])
                    if t is not None:
                        v = value[j] + scores[t]
                        # of equal paths the one whose last piece begins first stays
                        if v > best or (found < 0 and j == i - 1):
                            best, found, at = v, t, j
                last.append(found)
                back.append(at)
                value.append(best)

    def _meeting(self) -> int:
        """The last boundary that the paths back from all boundaries with a future have in common."""
        alive = set(range(len(self.text) - self.model.longest + 1, len(self.text) + 1))
        while len(alive) > 1:
            top = max(alive)
            alive.remove(top)
            alive.add(self.back[top])
        return alive.pop()

    def _commit(self, upto: int) -> list[int]:
        if not upto:
            return []
        path, i = [], upto
        while i:
            path.append((self.last[i], self.back[i], i))
            i = self.back[i]
        path.reverse()
        out: list[int] = []
        for t, a, z in path:
            if t >= 0:
                out.append(t)
            elif self.model.bytes:
                out += [self.model.bytes[b] for b in self.text[a:z].encode()]
            elif not out or out[-1] != self.model.unknown:
                out.append(self.model.unknown)
        self.before = self.last[upto]
        base = self.value[upto]
        self.text = self.text[upto:]
        self.last = [-1, *self.last[upto + 1 :]]
        self.back = [0, *(x - upto for x in self.back[upto + 1 :])]
        self.value = [0.0, *(x - base for x in self.value[upto + 1 :])]
        return out


class PairRule:
    """Whether two BPE pieces may stand side by side: the merge rule makes just them of their text.

    A merge across their border would have to come before the merges that made the border pieces.
    Both are taken apart along the border, latest merge first, to see whether one does.
    """

    def __init__(self, model: Model, memo: int = 1_000_000):
        self.model, self.memo = model, memo
        self.known: dict[int, bool] = {}
        order = sorted(model.ids.values(), key=lambda t: -model.scores[t])
        seen: dict[float, int] = {}
        self.rank = dict.fromkeys(order, -1)  # single characters are there from the start
        for t in order:
            if len(model.pieces[t]) > 1:
                self.rank[t] = len(seen)
                seen[model.scores[t]] = seen.get(model.scores[t], 0) + 1
        self.tied = {t for t in order if len(model.pieces[t]) > 1 and seen[model.scores[t]] > 1}
        self.halves: dict[int, tuple[int, int] | None] = {}

    def merged(self, text: str, until: int = 1) -> list[str]:
        """The merge rule by hand: the adjacent pair of best score first, the leftmost of equals."""
        get, scores = self.model.ids.get, self.model.scores
        parts = list(text)
        while len(parts) > until:
            best, at = None, -1
            for i in range(len(parts) - 1):
                t = get(parts[i] + parts[i + 1])
                if t is not None and (best is None or scores[t] > best):
                    best, at = scores[t], i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def split(self, t: int) -> tuple[int, int] | None:
        """The two pieces whose merge makes ``t``; None for a single character."""
        if t not in self.halves:
            text = self.model.pieces[t]
            if len(text) == 1:
                self.halves[t] = None
            else:
                a, b = self.merged(text, 2)
                self.halves[t] = (self.model.ids[a], self.model.ids[b])
        return self.halves[t]

    def border(self, a: int, b: int) -> bool:
        get, pieces, rank = self.model.ids.get, self.model.pieces, self.rank
        limit = len(rank) + 1
        while True:
            c = get(pieces[a] + pieces[b])
            if c is not None and rank[c] < limit:
                return False
            for left in (True, False) if rank[a] > rank[b] else (False, True):
                half = self.split(a if left else b)
                if half:
                    if left:
                        limit, a = rank[a], half[1]
                    else:
                        limit, b = rank[b] + 1, half[0]
                    break
            else:
                return True

    def fits(self, a: int, b: int) -> bool:
        key = a << 24 | b
        known = self.known.get(key)
        if known is None:
            if a in self.tied or b in self.tied:
                x, y = self.model.pieces[a], self.model.pieces[b]
                known = self.merged(x + y) == [x, y]
            else:
                known = self.border(a, b)
            if len(self.known) < self.memo:
                self.known[key] = known
        return known


class SentencePieceCodec:
    """Encodes and decodes whole texts; frequent words are remembered."""

    def __init__(self, path: str, memo_words: int = MEMO_WORDS):
        self.model = Model(path)
        self.viterbi = StreamingViterbi(self.model)
        self.memo_words = memo_words
        self.memo: dict[str, bytes] = {}  # a word behind a space -> ids
        self.heads: dict[str, bytes] = {}  # a word at the start of a later line -> ids
        self.newline = self._ids("\n")

    def _ids(self, normal: str) -> bytes:
        return np.array(self.viterbi.push(normal) + self.viterbi.finish(), "<u4").tobytes()

    def _word(self, normal: str) -> bytes:
        return array("I", self.viterbi.settled(normal)).tobytes()

    def encode(self, text: str) -> bytes:
        """Ids of a text, as little-endian uint32 bytes."""
        if not text:
            return b""
        if not (self.model.words_settle and self.model.newline_settles and self.model.dummy_prefix) or "  " in text or MARK in text or text[0] == " " or text[-1] == " " or " \n" in text or "\n " in text:
            return self._ids((MARK if self.model.dummy_prefix else "") + text.replace(" ", MARK))
        out = []
        for n, line in enumerate(text.split("\n")):
            words = line.split(" ")
            if n:
                out.append(self.newline)
                head = words[0]
                ids = self.heads.get(head)
                if ids is None:
                    ids = self._word(head)
                    if len(self.heads) < self.memo_words // 4:
                        self.heads[head] = ids
                out.append(ids)
                words = words[1:]
            elif not line:  # only the dummy prefix stands before the first newline
                words = [""]
            found = list(map(self.memo.get, words))
            if None in found:
                for i, ids in enumerate(found):
                    if ids is None:
                        w = words[i]
                        found[i] = ids = self.memo.get(w) or self._word(MARK + w)
                        if len(self.memo) < self.memo_words:
                            self.memo[w] = ids
            out += found
        return b"".join(out)

    def decode(self, ids: np.ndarray) -> str:
        model = self.model
        pieces, types = model.pieces, model.types
        if not model.bytes:
            text = "".join([pieces[i] if types[i] == NORMAL else " ⁇ " if types[i] == UNKNOWN else "" for i in ids.tolist()])
        else:
            raw = []
            for i in ids.tolist():
                kind = types[i]
                if kind == NORMAL:
                    raw.append(pieces[i].encode())
                elif kind == BYTE:
                    raw.append(bytes([int(pieces[i][3:5], 16)]))
                elif kind == UNKNOWN:
                    raw.append(b" \xe2\x81\x87 ")
            text = b"".join(raw).decode("utf-8", "replace")
        text = text.replace(MARK, " ")
        return text[1:] if model.dummy_prefix and text[:1] == " " else text


_codecs: dict[str, SentencePieceCodec] = {}


def codec(path: str) -> SentencePieceCodec:
    if path not in _codecs:
        _codecs[path] = SentencePieceCodec(path)
    return _codecs[path]


def encoded(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ``ids`` (array of int) of every document."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = codec(model)
        for batch in batches(it, 500):
            raw = [np.frombuffer(sp.encode(t), "<i4") for t in text_list(batch.column("text"))]
            bounds = np.cumsum([0, *map(len, raw)], dtype=np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(bounds, np.concatenate(raw) if raw else np.zeros(0, "<i4"))], ["doc_id", "ids"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decoded(ids: DataFrame, model: str) -> DataFrame:
    """doc_id and ``text`` of documents given as ``ids``; null ids give an empty text."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = codec(model)
        for batch in batches(it, 500):
            texts = [sp.decode(np.array(x or [], np.int64)) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return ids.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def encode_documents(docs: DataFrame, model: str) -> DataFrame:
    """A row for each document: doc_id, n_tokens, ids_crc32, and whether decoding gives the text back."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = codec(model)
        for batch in batches(it, 500):
            texts = text_list(batch.column("text"))
            ids = [np.frombuffer(sp.encode(t), "<u4") for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([crc_u32(x) for x in ids], pa.int64()),
                    pa.array([sp.decode(x) == t for x, t in zip(ids, texts, strict=True)], pa.bool_()),
                ],
                ["doc_id", "n_tokens", "ids_crc32", "round_trip"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_tokens long, ids_crc32 long, round_trip boolean")
