"""Boolean phrase search: quoted phrases joined by AND and OR, with parentheses.

One grammar, two targets: a condition on text columns, and the escaped query string of a remote service.  Which
of AND and OR binds tighter is not said anywhere, so the flat form ``"a" OR "b" AND "c"`` keeps the reading that
it has always had here, in which an OR belongs to the phrase before it: ``("a" OR "b") AND "c"``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.nulls import all_of, any_of, holds

TOKEN = re.compile(r'\s*(?:"((?:[^"\\]|\\.)*)"|(AND|OR)\b|([()]))', re.IGNORECASE)


@dataclass(frozen=True)
class Phrase:
    text: str


@dataclass(frozen=True)
class Both:
    """All of the parts (``every``) or one of them."""

    parts: tuple
    every: bool


def _tokens(query: str) -> list:
    """Phrases, and AND, OR and parentheses as text.

    Query files escape the quotes around phrases: ``\\"food\\"``.  Where none stands unescaped they are the quotes;
    within quotes, a backslash makes the next character part of the phrase.
    """
    text, out, at = query.strip(), [], 0
    if not re.search(r'(?<!\\)"', text):
        text = text.replace('\\"', '"')
    while at < len(text):
        m = TOKEN.match(text, at)
        if not m:
            if text[at:].strip():
                raise ValueError(f"no phrase, operator or parenthesis at {at}: {text[at:at + 20]!r}")
            break
        at = m.end()
        out.append(Phrase(re.sub(r"\\(.)", r"\1", m[1])) if m[1] is not None else (m[2] or m[3]).upper())
    return out


def parse(query: str) -> Phrase | Both:
    """The tree of a query; phrases side by side are joined by AND."""
    tokens = _tokens(query)
    at = 0

    def sequence(depth: int) -> Phrase | Both:
        nonlocal at
        groups: list[list] = []
        join = "AND"
        while at < len(tokens) and tokens[at] != ")":
            token = tokens[at]
            at += 1
            if token in ("AND", "OR"):
                if not groups:
                    raise ValueError(f"{token} without a phrase before it")
                join = token
                continue
            if token == "(":
                token = sequence(depth + 1)
                if at >= len(tokens):
                    raise ValueError("parentheses are unbalanced")
                at += 1
            if groups and join == "OR":
                groups[-1].append(token)
            else:
                groups.append([token])
            join = "AND"
        if at < len(tokens) and not depth:
            raise ValueError("parentheses are unbalanced")
        if not groups or tokens[at - 1] in ("AND", "OR"):
            raise ValueError("a phrase is missing")
        parts = tuple(g[0] if len(g) == 1 else Both(tuple(g), False) for g in groups)
        return parts[0] if len(parts) == 1 else Both(parts, True)

    return sequence(0)


def condition(tree: Phrase | Both, *columns: str) -> Column:
    """Rows that hold the phrases in any of the columns, in any case; false for null."""
    if isinstance(tree, Phrase):
        return any_of([holds(F.contains(F.lower(F.col(c)), F.lit(tree.text.lower()))) for c in columns])
    return (all_of if tree.every else any_of)([condition(p, *columns) for p in tree.parts])


def written(tree: Phrase | Both) -> str:
    """The tree as a query again, every group in parentheses."""
    if isinstance(tree, Phrase):
        return '"' + re.sub(r'(["\\])', r"\\\1", tree.text) + '"'
    return (" AND " if tree.every else " OR ").join(written(p) if isinstance(p, Phrase) else f"({written(p)})" for p in tree.parts)


def escaped(text: str) -> str:
    """Text as it goes between the quotes of the service's query language."""
    return re.sub(r'(["\\])', r"\\\1", text)


def remote_query(query: str, source: str, returns: str, year: str, years: tuple[int, int], within: str = "") -> str:
    """The service's search for a query: the same tree, escaped."""
    place = f"{source} in {within}" if within else source
    return f'search {place} for "{escaped(written(parse(query)))}" where {year} in [{years[0]}:{years[1]}] return {returns}'


def matches(query: str, *columns: str) -> Column:
    return condition(parse(query), *columns)


def in_years(column: str, first: int, last: int) -> Column:
    return F.col(column).between(first, last)


def has_code(column: str, codes: list[str]) -> Column:
    """Some code of the list column is one of ``codes``; nulls in the list are ignored."""
    return holds(F.arrays_overlap(F.filter(column, lambda c: c.isNotNull()), F.array(*[F.lit(c) for c in codes])))


def code_or_none(column: str, codes: list[str]) -> Column:
    """No code at all, or one of ``codes``."""
    return F.col(column).isNull() | (F.size(column) == 0) | has_code(column, codes)
