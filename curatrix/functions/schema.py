"""Schema alignment for tables that evolve."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def align(df: DataFrame, target: T.StructType) -> DataFrame:
    """The target's columns in its order: cast, missing ones null, others dropped.

    Nested values that go into text columns become JSON.
    """
    have = {f.name: f.dataType for f in df.schema}
    out = []
    for f in target:
        if f.name not in have:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif isinstance(f.dataType, T.StringType) and isinstance(have[f.name], (T.ArrayType, T.StructType, T.MapType)):
            out.append(F.to_json(f.name).alias(f.name))
        else:
            out.append(F.col(f.name).cast(f.dataType).alias(f.name))
    return df.select(*out)


def add_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Columns that are not there yet, as null of the given type."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns})


def union(*frames: DataFrame) -> DataFrame:
    """Union by name; columns missing in one are null there."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def ordered_unique(*groups: list[str]) -> list[str]:
    return list(dict.fromkeys(c for g in groups for c in g))


def column_range(df: DataFrame, first: str, last: str) -> DataFrame:
    """Columns from one name to another, both included."""
    names = df.columns
    return df.select(*names[names.index(first) : names.index(last) + 1])


def suffixed(df: DataFrame, suffix: str, keep: tuple[str, ...] = ()) -> DataFrame:
    return df.withColumnsRenamed({c: f"{c}{suffix}" for c in df.columns if c not in keep})
