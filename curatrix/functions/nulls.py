"""Comparisons and joins in which null is a value like another.

The curation rules come from data frames where ``null == null`` matches in joins, ``null != x`` is
true, and comparisons with null are false.  These helpers state those rules once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def same(a: Column | str, b: Column | str) -> Column:
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return a.eqNullSafe(b)


def differs(a: Column | str, value) -> Column:
    """``a != value``, true for null."""
    a = F.col(a) if isinstance(a, str) else a
    return ~a.eqNullSafe(F.lit(value))


def holds(condition: Column) -> Column:
    """The condition, false where it is null."""
    return F.coalesce(condition, F.lit(False))


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, null matching null; the keys of ``left`` are kept once."""
    renamed = right.withColumnsRenamed({k: f"__right_{k}" for k in keys})
    on = all_of([F.col(k).eqNullSafe(F.col(f"__right_{k}")) for k in keys])
    return left.join(renamed, on, how).drop(*[f"__right_{k}" for k in keys])
