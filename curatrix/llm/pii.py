"""Operator 6, personal data: fixed base patterns, and a semi-Markov CRF that adds spans to them.

The base finds e-mail addresses, IPv4 addresses, card and phone numbers by pattern and checks.  The
CRF looks where it may add something: around "@", spelled-out "at" and digits that no letter parts,
as far as a segment may reach from there, cut into atoms (runs of letters, runs of digits, single other characters).  A segmentation of
a region is a sequence of segments, each an entity of a kind (at most MAX_ATOMS atoms, no white
space at its ends) or one outside atom.  Whole-span features score a segment of a kind: its shape,
number of digits and groups, checksum, separators, the word before it.  Forward and backward sums
over all segmentations, bounded by MAX_ATOMS, give each candidate its probability; the best
segmentation decides boundaries and kinds jointly, and of its entities those with probability
CERTAIN or more that overlap no base span are added.

The model is trained here, by gradient ascent on segmentations of phrases made from formats: numbers
and addresses as people write them, and look-alikes that are none (hashes, versions, dates, prices,
keys, numbers that fail the checksum).  Training is deterministic, on the driver; some sixty weights
go to the executors.

Defined results: null and empty texts have no spans; offsets count code points, end exclusive;
repeated rows are treated alike; other columns are ignored (or kept, by :func:`mask`).
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, text_list

KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]*\Z")
#: The quantifiers give nothing back, which keeps long runs of digits linear; no match is lost by it.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

Span = tuple[int, int, int]  # start, end, kind


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if i % 2 == 0 else (d * 2 - 9 if d > 4 else d * 2)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the e-mail pattern, leftmost and non-overlapping, found from each "@"."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", done)


def base_spans(text: str) -> list[Span]:
    """The contract's spans, by start and then kind."""
    out: list[Span] = []
    if "@" in text:
        out += [(a, z, 0) for a, z in emails(text)]
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                out.append((m.start(), m.end(), 1))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = m[0].replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    out.append((m.start(), m.end(), 2))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 10 <= sum(c in "0123456789" for c in m[0]) <= 15:
                    out.append((m.start(), m.end(), 3))
    return sorted(out, key=lambda s: (s[0], s[2]))


# --- the semi-Markov CRF ---------------------------------------------------------------------------

#: Atoms of a candidate segment at most; regions reach so far around what may be part of one.
MAX_ATOMS = 24
CERTAIN = 0.95
ATOM = re.compile(r"[0-9]+|[^\W\d_]+|\s|.", re.DOTALL)
AROUND = re.compile(r"(?:[0-9]++|[^\W\d_]++|\s|.){0,%d}+" % MAX_ATOMS, re.DOTALL)
#: Every candidate with digits alone has four of them or more, and no letter between.
TRIGGER = re.compile(r"[0-9](?:[\W_]*+[0-9]){3,}+|[0-9]{3}|@|[\[({]\s?at\s?[\])}]|\sat\s\S+\sdot\s", re.IGNORECASE)
CUES = {
    "phone": 3, "tel": 3, "telephone": 3, "call": 3, "mobile": 3, "fax": 3, "cell": 3,
    "email": 0, "mail": 0, "contact": 0, "write": 0,
    "ip": 1, "host": 1, "address": 1,
    "card": 2, "visa": 2, "credit": 2, "pay": 2,
}
FULL_EMAIL = re.compile(r"[\w.%+-]+\s?(?:@|[\[({]\s?at\s?[\])}]|\sat\s)\s?[\w-]+(?:\s?(?:\.|[\[({]\s?dot\s?[\])}]|\sdot\s)\s?[\w-]+)*\s?(?:\.|[\[({]\s?dot\s?[\])}]|\sdot\s)\s?[A-Za-z]{2,}", re.IGNORECASE)
FULL_PHONE = re.compile(r"(?:\+?[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}|0[1-9](?:([ .-])[0-9]{2})(?:\1[0-9]{2}){3}")
FULL_CARD = re.compile(r"[0-9]{4}([ .-]?)[0-9]{4}\1[0-9]{4}\1[0-9]{2,7}|[0-9]{4}([ .-]?)[0-9]{6}\2[0-9]{5}")
FULL_IP = re.compile(r"[0-9]{1,3}(?:\s?\.\s?[0-9]{1,3}){3}|[0-9]{1,3}(?:\[\.\][0-9]{1,3}){3}")
FULL = (FULL_EMAIL, FULL_IP, FULL_CARD, FULL_PHONE)


def segment_features(kind: int, span: str, before: str, left: str, right: str) -> list[str]:
    """Names of the features of a whole segment as an entity of a kind."""
    digits = sum(c.isdigit() for c in span)
    whole = FULL[kind].fullmatch(span) is not None
    spaces = span.count(" ")
    out = [f"{kind}", f"{kind} full" if whole else f"{kind} not full", f"{kind} spaces {min(spaces, 4)}"]
    if kind == 2:
        number = "".join(c for c in span if c.isdecimal())
        out += [f"2 luhn {14 <= digits <= 19 and luhn(number)}", f"2 digits {min(max(digits, 12), 20)}"]
    elif kind == 3:
        out += [f"3 digits {min(max(digits, 6), 16)}", f"3 plus {span[0] == '+'}", f"3 letters {any(c.isalpha() for c in span)}"]
    elif kind == 1:
        parts = re.findall(r"[0-9]+", span)
        out += [f"1 parts {len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)}"]
    else:
        out += [f"0 at {span.count('@') == 1 or bool(re.search(r'[\[({]\s?at\s?[\])}]| at ', span, re.I))}", f"0 bracket {'[' in span or '(' in span}"]
    if before in CUES:
        out.append(f"{kind} cue {CUES[before] == kind}")
    if left and (left.isalnum() or left in "._-+="):
        out.append(f"{kind} joined left")
    if right and (right.isalnum() or right in "_-+=@"):
        out.append(f"{kind} joined right")
    return out


def atoms(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in ATOM.finditer(text)]


def candidates(text: str, cut: list[tuple[int, int]]) -> list[tuple[int, int, int, list[str]]]:
    """Possible entities of a region: (first atom, end atom, kind, features).

    A segment needs three digits or an "at", and no white space at its ends; others score minus infinity.
    """
    out = []
    n = len(cut)
    pieces = [text[a:z] for a, z in cut]
    digit_counts = [sum(x.isdigit() for x in p) for p in pieces]
    letters = [any(x.isalpha() for x in p) for p in pieces]
    # where the next atom stands that an address needs
    next_at = [n] * (n + 1)
    for i in range(n - 1, -1, -1):
        next_at[i] = i if pieces[i] == "@" or pieces[i].lower() == "at" else next_at[i + 1]
    for i in range(n):
        a = cut[i][0]
        c = text[a]
        if not (c.isalnum() or c in "+("):
            continue
        stop = min(n, i + MAX_ATOMS)
        address = next_at[i] < stop
        if letters[i] and not address:
            continue
        left = text[a - 1] if a else ""
        word = re.search(r"([^\W\d_]+)[\s:=.#]*\Z", text[max(0, a - 24) : a])
        before = word[1].lower() if word else ""
        digits, alpha = 0, False
        for j in range(i + 1, stop + 1):
            digits += digit_counts[j - 1]
            alpha = alpha or letters[j - 1]
            if alpha and not address:
                break
            z = cut[j - 1][1]
            if (alpha or digits < 4) and next_at[i] >= j or not text[z - 1].isalnum():
                continue
            span = text[a:z]
            right = text[z] if z < len(text) else ""
            kinds = []
            if "@" in span or re.search(r"\bat\b", span, re.I):
                kinds.append(0)
            if 4 <= digits <= 12 and span.count(".") >= 3 and not alpha:
                kinds.append(1)
            if 12 <= digits <= 20 and not alpha:
                kinds.append(2)
            if 7 <= digits <= 16 and not alpha:
                kinds.append(3)
            out += [(i, j, kind, segment_features(kind, span, before, left, right)) for kind in kinds]
    return out


class SemiCRF:
    """Weights of named features; forward, backward and best segmentation of a region."""

    def __init__(self, weights: dict[str, float]):
        self.weights = weights

    def score(self, names: list[str]) -> float:
        get = self.weights.get
        return sum(get(x, 0.0) for x in names)

    def marginals(self, n: int, segments: list[tuple[int, int, int, list[str]]]) -> tuple[np.ndarray, float]:
        """Probability of each candidate segment, and the log of the sum over segmentations."""
        scores = [self.score(s[3]) for s in segments]
        ending: list[list[int]] = [[] for _ in range(n + 1)]
        starting: list[list[int]] = [[] for _ in range(n + 1)]
        for k, s in enumerate(segments):
            ending[s[1]].append(k)
            starting[s[0]].append(k)
        forward, backward = [0.0] * (n + 1), [0.0] * (n + 1)
        for j in range(1, n + 1):
            forward[j] = log_sum([forward[j - 1], *(forward[segments[k][0]] + scores[k] for k in ending[j])])
        for i in range(n - 1, -1, -1):
            backward[i] = log_sum([backward[i + 1], *(backward[segments[k][1]] + scores[k] for k in starting[i])])
        z = forward[n]
        return np.array([math.exp(forward[s[0]] + x + backward[s[1]] - z) for s, x in zip(segments, scores, strict=True)]), z

    def best(self, n: int, segments: list[tuple[int, int, int, list[str]]]) -> list[int]:
        """The entities of the best segmentation, as numbers of candidates."""
        ending: list[list[int]] = [[] for _ in range(n + 1)]
        for k, s in enumerate(segments):
            ending[s[1]].append(k)
        value, back = [0.0] * (n + 1), [-1] * (n + 1)
        for j in range(1, n + 1):
            value[j] = value[j - 1]
            for k in ending[j]:
                v = value[segments[k][0]] + self.score(segments[k][3])
                if v > value[j]:
                    value[j], back[j] = v, k
        out, j = [], n
        while j:
            if back[j] < 0:
                j -= 1
            else:
                out.append(back[j])
                j = segments[back[j]][0]
        return out[::-1]


def log_sum(values: list[float]) -> float:
    if len(values) == 1:
        return values[0]
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values))


def training_phrases(seed: int = 7, n: int = 700) -> list[tuple[str, list[Span]]]:
    """Phrases with marked entities, made from formats; and look-alikes without."""
    rnd = random.Random(seed)
    words = "lorem ipsum dolor sit amet in the of and to room order item page invoice total model part build node".split()

    def number(k: int) -> str:
        return "".join(rnd.choice("0123456789") for _ in range(k))

    def card(sep: str) -> str:
        body = number(15)
        digits = next(body + c for c in "0123456789" if luhn(body + c))
        return sep.join(digits[i : i + 4] for i in range(0, 16, 4))

    def word(a: int = 3, z: int = 8) -> str:
        return "".join(rnd.choice("abcdefghijklmnoprstuvw") for _ in range(rnd.randint(a, z)))

    def entity() -> tuple[str, int]:
        kind = rnd.randrange(4)
        if kind == 0:
            at = rnd.choice(["@", "@", " [at] ", "[at]", " (at) ", " at "])
            dot = rnd.choice([" [dot] ", "[dot]", " (dot) "]) if at not in ("@", " at ") else (" dot " if at == " at " else ".")
            return f"{word()}{rnd.choice(['', '.' + word(), number(2)])}{at}{word()}{dot}{rnd.choice(['com', 'org', 'net', 'de'])}", 0
        if kind == 1:
            dot = rnd.choice([".", ".", "[.]", " . "])
            return dot.join(str(rnd.randrange(256)) for _ in range(4)), 1
        if kind == 2:
            return card(rnd.choice(["", " ", "-", "."])), 2
        sep = rnd.choice([" ", "-", "."])
        if rnd.random() < 0.2:
            return sep.join([f"0{rnd.randint(1, 9)}", *(number(2) for _ in range(4))]), 3
        area = rnd.choice([f"({number(3)}) ", f"{number(3)}{sep}"])
        return f"{rnd.choice(['', '', '+1 ', '1 ', '+49 '])}{area}{number(3)}{'-' if area[0] == '(' else sep}{number(4)}", 3

    def alike() -> str:
        kind = rnd.randrange(12)
        if kind == 0:
            return "".join(rnd.choice("0123456789abcdef") for _ in range(rnd.choice([18, 32, 40])))
        if kind == 1:
            return ".".join(str(rnd.randrange(20)) for _ in range(rnd.choice([2, 3, 5])))
        if kind == 2:
            return f"{rnd.randrange(1990, 2030)}-{rnd.randrange(1, 13):02}-{rnd.randrange(1, 29):02}"
        if kind == 3:
            return f"{number(rnd.randint(1, 3))},{number(3)}.{number(2)}"
        if kind == 4:
            body = number(16)
            return body if not luhn(body) else body[:-1] + str((int(body[-1]) + 1) % 10)
        if kind == 5:
            return number(rnd.choice([3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13]))
        if kind == 6:
            return f"AKIA{''.join(rnd.choice('ABCDEFGHIJKLMNOP234567') for _ in range(16))}"
        if kind == 7:
            return f"{word()} at {word()} {number(3)}"
        if kind == 8:
            return f"{number(3)}.{number(3)}.{number(3)}.{rnd.randrange(256, 999)}"
        if kind == 9:
            return f"{number(rnd.randint(2, 4))}-{number(rnd.randint(2, 5))}-{number(rnd.randint(1, 3))}"
        if kind == 10:
            return rnd.choice([" ", ", ", "-", " . "]).join(str(rnd.randint(10, 99)) for _ in range(rnd.choice([2, 3, 5, 6])))
        return f"@{word()} {number(4)}"

    cues = {0: ["email", "contact", "mail:"], 1: ["ip", "host", "ip:"], 2: ["card", "visa", "card:"], 3: ["phone", "call", "tel:"]}
    out = []
    for _ in range(n):
        text, spans = rnd.choice(words), []
        for _ in range(rnd.randint(1, 3)):
            text += " " + rnd.choice(words) + " "
            if rnd.random() < 0.5:
                body, kind = entity()
                if rnd.random() < 0.4:
                    text += rnd.choice(cues[kind]) + " "
                spans.append((len(text), len(text) + len(body), kind))
                text += body
            else:
                text += alike()
        out.append((text + rnd.choice([".", "", ",", " " + rnd.choice(words)]), spans))
    return out


@lru_cache(1)
def trained(rounds: int = 60, rate: float = 0.5, penalty: float = 1e-3) -> SemiCRF:
    """Weights by Adagrad on the log-likelihood of the training phrases' segmentations."""
    data = []
    names: dict[str, int] = {}
    for text, spans in training_phrases():
        cut = atoms(text)
        segments = candidates(text, cut)
        truth = {(a, z, kind) for a, z, kind in spans}
        gold = np.array([(cut[i][0], cut[j - 1][1], kind) in truth for i, j, kind, _ in segments], float)
        ids = [[names.setdefault(f, len(names)) for f in s[3]] for s in segments]
        data.append((len(cut), segments, gold, ids))
    weights, squares = np.zeros(len(names)), np.full(len(names), 1e-6)
    order = list(names)
    for _ in range(rounds):
        model = SemiCRF(dict(zip(order, weights.tolist(), strict=True)))
        gradient = -penalty * len(data) * weights / 10
        for n, segments, gold, ids in data:
            if segments:
                for d, own in zip((gold - model.marginals(n, segments)[0]).tolist(), ids, strict=True):
                    if abs(d) > 1e-6:
                        for f in own:
                            gradient[f] += d
        squares += gradient**2
        weights += rate * gradient / np.sqrt(squares)
    return SemiCRF(dict(zip(order, weights.tolist(), strict=True)))


def regions(text: str) -> list[tuple[int, int]]:
    """Stretches of the text that may hold an entity, as far as it may reach, merged where they meet."""
    out: list[tuple[int, int]] = []
    n, back = len(text), ""
    for m in TRIGGER.finditer(text):
        back = back or text[::-1]
        a, z = n - AROUND.match(back, n - m.start()).end(), AROUND.match(text, m.end()).end()
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], z)
        else:
            out.append((a, z))
    return out


def added_spans(text: str, base: list[Span], model: SemiCRF) -> list[Span]:
    """Entities that the CRF finds beyond the base spans."""
    out = []
    for a, z in regions(text):
        # base spans stay: what lies between them is segmented
        inside = sorted((max(a, s), min(z, e)) for s, e, _ in base if s < z and e > a)
        edges, at = [], a
        for s, e in inside:
            if s > at:
                edges.append((at, s))
            at = max(at, e)
        if at < z:
            edges.append((at, z))
        for lo, hi in edges:
            part = text[lo:hi]
            if not TRIGGER.search(part):
                continue
            cut = atoms(part)
            segments = candidates(part, cut)
            if not segments:
                continue
            chances, _ = model.marginals(len(cut), segments)
            for k in model.best(len(cut), segments):
                i, j, kind, _ = segments[k]
                s, e = lo + cut[i][0], lo + cut[j - 1][1]
                # a segment that the region's edge cuts off is no whole segment
                clipped = (i == 0 and s > 0 and s == a and text[s - 1].isalnum()) or (j == len(cut) and e < len(text) and e == z and text[e].isalnum())
                if chances[k] >= CERTAIN and not clipped:
                    out.append((s, e, kind))
    return out


def find_spans(text: str, model: SemiCRF) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans."""
    base = base_spans(text)
    more = added_spans(text, base, model)
    return base, sorted(base + more, key=lambda s: (s[0], s[2])) if more else base


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{z}" for a, z, k in spans)


def personal_data(docs: DataFrame) -> DataFrame:
    """A row for each document: doc_id, counts of the base kinds, base_sha256, spans."""

    model = trained()

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it):
            found = [find_spans(t, model) for t in text_list(batch.column("text"))]
            counts = [pa.array([sum(k == kind for _, _, k in base) for base, _ in found], pa.int64()) for kind in range(4)]
            digests = [hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found]
            columns = [batch.column("doc_id"), *counts, pa.array(digests, pa.string()), pa.array([joined(spans) for _, spans in found], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def mask(docs: DataFrame) -> DataFrame:
    """All documents, each span of personal data in ``text`` replaced by its kind in brackets.

    ``n_chars``, where it is a column and not null, follows the new text.
    """

    def cover(text: str | None, model: SemiCRF) -> str | None:
        if not text:
            return text
        spans = find_spans(text, model)[1]
        if not spans:
            return text
        out, at = [], 0
        for a, z, kind in spans:
            if a >= at:
                out += [text[at:a], f"[{KINDS[kind].upper()}]"]
            at = max(at, z)
        return "".join(out) + text[at:]

    model = trained()

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it):
            new = [cover(t, model) for t in batch.column("text").to_pylist()]
            columns = list(batch.columns)
            columns[batch.schema.get_field_index("text")] = pa.array(new, batch.schema.field("text").type)
            if "n_chars" in batch.schema.names:
                at = batch.schema.get_field_index("n_chars")
                columns[at] = pa.array([n if n is None or t is None else len(t) for n, t in zip(columns[at].to_pylist(), new, strict=True)], batch.schema.field("n_chars").type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return docs.mapInArrow(run, docs.schema)
