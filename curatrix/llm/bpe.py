"""Byte-level BPE ids by the ``tokenizers`` library, with a bounded memo of words.

A pre-token of this kind of tokenizer never runs from a non-space character into a following
space or newline, so a text may be cut in front of every single space or newline without changing
its ids.  Recent and frequent words are then encoded once per worker.  Texts in which a cut is not safe (two
white-space characters in a row, other kinds of white space) are encoded whole, and so are texts that
hold an added token's literal, which the library's default turns into that token's id.

New words go to the library's model many at a time.  Where no piece of the vocabulary reaches over the end
of a pre-token, no merge does, and words in a row give the ids that each gives alone.  ``_merges_stay_inside``
checks this for plain words (ASCII but for the apostrophe, Latin letters); the library then has no
pre-tokens to find.  Other words, and all words of a vocabulary that fails, take its usual way.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np

OTHER_SPACE = re.compile(r"[^\S \n]")

#: Words remembered by each Python worker, some 250 bytes each; beyond it the ones not met lately are forgotten.
MEMO_WORDS = 400_000

#: Words that the library's model gets as one sequence.
ROW_WORDS = 32

#: A word that may not stand in such a row.  The apostrophe begins contractions, which end by what follows.
NOT_PLAIN = re.compile(r"[^!-&(-~À-ÖØ-öø-ſ\n]|^\n?$")
PLAIN_BYTES = bytes({*range(0x21, 0x7F), *range(0x80, 0xC0), 0xC3, 0xC4, 0xC5} - {0x27}) + b" \n\0"
#: What a piece made of such bytes may be: (part of) one pre-token, or white space in a row, which plain words do not have.
INSIDE = re.compile(rb" ?(?:[A-Za-z\x80-\xc5]+|[0-9]+|[!-/:-@\[-`{-~]+)|[ \n]+")

# byte-level vocabularies write a byte as one character: itself if it can be seen, else the next one from 256 on
_SEEN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
CHARACTER = np.zeros(256, "<u2")
CHARACTER[_SEEN] = _SEEN
CHARACTER[CHARACTER == 0] = np.arange(256, 512 - len(_SEEN))
BYTE = {chr(c): b for b, c in enumerate(CHARACTER.tolist())}
ROW_CHARACTER = CHARACTER.copy()
ROW_CHARACTER[0] = 0  # between rows

_encoders: dict[tuple[str, int], "WordMemoEncoder"] = {}


class WordMemoEncoder:
    """``encode(texts)`` gives each text's ids as little-endian uint32 bytes."""

    def __init__(self, path: str, memo_words: int = MEMO_WORDS, added: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        # literals of added tokens, if they are to give their ids
        literals = [re.escape(t.content) for t in self.tok.get_added_tokens_decoder().values()] if added else []
        self.added = re.compile("|".join(literals)) if literals else None
        self.memo_words = memo_words
        # word that follows a space or newline -> ids; None: unsafe.  What was met since the last turn, and before it
        self.memo: dict[str, bytes | None] = {}
        self.older: dict[str, bytes | None] = {}
        size = self.tok.get_vocab_size()
        self.width = np.array([self._bytes_of(i) for i in range(size)], dtype=np.int64)
        self.rows = None
        if self._merges_stay_inside():
            self.rows = Tokenizer(self.tok.model)
            self.rows.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\0")

    def _merges_stay_inside(self) -> bool:
        """Whether plain words in a row have the ids that they have alone."""
        from tokenizers import models, pre_tokenizers

        model, cut = self.tok.model, self.tok.pre_tokenizer
        if not isinstance(model, models.BPE) or model.dropout or model.ignore_merges or model.continuing_subword_prefix or model.end_of_word_suffix:
            return False
        if self.tok.normalizer is not None or not isinstance(cut, pre_tokenizers.ByteLevel) or cut.add_prefix_space or not cut.use_regex:
            return False
        added = {t.content for t in self.tok.get_added_tokens_decoder().values()}
        pieces = self.tok.get_vocab(with_added_tokens=True).keys() - added
        if not BYTE.keys() <= pieces or not all(BYTE.keys() >= set(p) for p in pieces):
            return False
        spelled = (bytes(map(BYTE.__getitem__, p)) for p in pieces)
        return all(INSIDE.fullmatch(p) for p in spelled if not p.translate(None, PLAIN_BYTES) and b"\0" not in p)

    def _bytes_of(self, i: int) -> int:
        """Bytes of text that id ``i`` stands for: a byte-level piece has one character a byte."""
        piece = self.tok.id_to_token(i)
        return len(piece) if piece else 0

    def whole(self, text: str) -> bytes:
        if self.added and self.added.search(text):
            self.tok.encode_special_tokens = False
            try:
                return np.array(self.tok.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
            finally:
                self.tok.encode_special_tokens = True
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _learn(self, words: list[str]) -> dict[str, bytes | None]:
        """Ids of words that follow a space or newline; None where a cut before the next word is not safe."""
        if not self.rows:
            return self._learn_any(words)
        raw = self._in_rows(words)
        new: dict[str, bytes | None] = {}
        if raw.translate(None, PLAIN_BYTES) or b"\xc3\x97" in raw or b"\xc3\xb7" in raw or not {"", "\n"}.isdisjoint(words) or raw.count(b"\0") * ROW_WORDS >= len(words):
            new = self._learn_any([w for w in words if NOT_PLAIN.search(w)])
            words = [w for w in words if w not in new]
            raw = self._in_rows(words)
        if words:
            new.update(zip(words, self._learn_rows(raw), strict=True))
        return new

    @staticmethod
    def _in_rows(words: list[str]) -> bytes:
        rows = [" ".join(words[i : i + ROW_WORDS]) for i in range(0, len(words), ROW_WORDS)]
        return (" " + "\0 ".join(rows)).replace(" \n", "\n").encode()

    def _learn_rows(self, raw: bytes) -> Iterator[bytes]:
        """Encode rows of plain words; each word begins with its space or newline."""
        own = np.frombuffer(raw, np.uint8)
        text = ROW_CHARACTER[own].tobytes().decode("utf-16-le")
        ids = np.array(self.rows.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")
        own = own[own != 0]
        place = np.zeros(len(own) + 1, np.int64)  # number of ids up to a byte at which an id ends
        place[np.cumsum(self.width[ids])] = np.arange(4, 4 * len(ids) + 4, 4)
        at = [*place[np.flatnonzero((own == 0x20) | (own == 0x0A))].tolist(), 4 * len(ids)]
        return map(ids.tobytes().__getitem__, map(slice, at, at[1:]))

    def _learn_any(self, words: list[str]) -> dict[str, bytes | None]:
        """Encode words in one go: joined, they are a text with a safe cut before each."""
        units = [w if w[:1] == "\n" else " " + w for w in words]
        joined = "".join(units)
        bad: dict[str, bytes | None] = {}
        if "" in words or "\n" in words or OTHER_SPACE.search(joined):
            bad = {w: None for w in words if w in ("", "\n") or OTHER_SPACE.search(w)}
            words = [w for w in words if w not in bad]
            units = [w if w[:1] == "\n" else " " + w for w in words]
            joined = "".join(units)
        if not units:
            return bad
        ids = np.array(self.tok.encode_batch_fast([joined], add_special_tokens=False)[0].ids, dtype="<u4")
        sizes = map(len, units) if joined.isascii() else map(len, map(str.encode, units))
        ends = np.cumsum(np.fromiter(sizes, np.int64, len(units)))
        at = ((np.searchsorted(np.cumsum(self.width[ids]), ends, side="left") + 1) * 4).tolist()
        raw = ids.tobytes()
        bad.update(zip(words, map(raw.__getitem__, map(slice, [0, *at[:-1]], at)), strict=True))
        return bad

    def _meet(self, missing: set[str]) -> None:
        """Bring words into the memo."""
        known = missing.intersection(self.older)
        self.memo.update(zip(known, map(self.older.get, known), strict=True))
        new = list(missing.difference(known))
        if new:
            self.memo.update(self._learn(new))

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [t.replace("\n", " \n").split(" ") for t in texts]
        self._meet(set(chain.from_iterable(split)).difference(self.memo))
        get = self.memo.__getitem__
        out = []
        for text, words in zip(texts, split, strict=True):
            ids, first = list(map(get, words)), words[0]
            if self.added and self.added.search(text):
                out.append(self.whole(text))
            elif first and first[0] != "\n" and None not in ids and not OTHER_SPACE.search(first):
                ids[0] = self.whole(first)  # it follows no space
                out.append(b"".join(ids))
            else:
                out.append(self.whole(text) if text else b"")
        if 2 * len(self.memo) > self.memo_words:
            # words in use come back from there
            self.older = self.memo if len(self.memo) <= self.memo_words else dict(islice(self.memo.items(), self.memo_words))
            self.memo = {}
        return out


def encoder(path: str, memo_words: int = MEMO_WORDS) -> WordMemoEncoder:
    """The worker's encoder for this vocabulary file; workers are reused, so is the memo.

    A smaller memo costs time and saves each worker some 200 bytes a word.
    """
    if (path, memo_words) not in _encoders:
        _encoders[path, memo_words] = WordMemoEncoder(path, memo_words, added=True)
    return _encoders[path, memo_words]


def encoder_size(path: str) -> int:
    """Ids of this vocabulary, from its file alone."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).get_vocab_size()
