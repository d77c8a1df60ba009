"""Text functions: markup, prompts, names, tokens."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def strip_markup(text: Column | str) -> Column:
    """Remove everything between angle brackets, brackets included."""
    return F.regexp_replace(text, "<[^>]*>", "")


def joined_text(title: Column | str, body: Column | str, separator: str = " [SEP] ") -> Column:
    """Title and body for an encoder; null counts as empty."""
    col = lambda x: F.col(x) if isinstance(x, str) else x
    return F.concat(F.coalesce(col(title), F.lit("")), F.lit(separator), F.coalesce(col(body), F.lit("")))


def has_content(*columns: str) -> Column:
    """All columns are neither null nor empty."""
    out = F.lit(True)
    for c in columns:
        out = out & F.coalesce(F.col(c) != "", F.lit(False))
    return out


def message(title: str, body: str) -> Column:
    """The user message of a request; a null prints as ``None``."""
    return F.concat(F.lit("Title: "), F.coalesce(F.col(title), F.lit("None")), F.lit("\n\nAbstract: "), F.coalesce(F.col(body), F.lit("None")))


def words(text: Column | str) -> Column:
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def too_long(text: Column | str, limit: int = 512) -> Column:
    """More white-space tokens than the encoder takes; null is not too long."""
    return F.coalesce(F.size(words(text)) > limit, F.lit(False))


def stamp(when: Column | None = None) -> Column:
    """A date as yymmdd; today if none is given."""
    return F.date_format(F.current_date() if when is None else when, "yyMMdd")


@F.pandas_udf(T.StringType())
def fold_accents(names: pd.Series) -> pd.Series:
    """Letters without their accents, what is not ASCII then dropped."""
    return names.map(lambda s: None if s is None else unicodedata.normalize("NFKD", s).encode("ascii", "ignore").decode("ascii"))


def as_bool(value: Column | str) -> Column:
    """Text, numbers or booleans to true, false or null; "false", "0", "no" and "" are false."""
    text = F.lower(F.trim((F.col(value) if isinstance(value, str) else value).cast("string")))
    return F.when(text.isNull(), None).otherwise(~text.isin("false", "0", "no", "", "0.0"))


def as_list(value: Column) -> Column:
    """A single text as a list of one; null stays null."""
    return F.when(value.isNotNull(), F.array(value))


def as_json(value: Column | str) -> Column:
    """Nested values as JSON text, serialised once, where they leave for a text column."""
    return F.to_json(value)
