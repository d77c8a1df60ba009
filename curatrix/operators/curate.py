"""Records: first of each id, latest versions, supersession, representatives, propagation.

Every choice among rows is a window with a complete order, so results do not depend on partitioning;
``row_number() = 1`` filters are planned as group limits, which cut partitions down before the
shuffle, so a hot key costs one row for each map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.nulls import all_of
from ..functions.text import has_content


def first_of_each(df: DataFrame, keys: list[str], order: list[Column], keep_null_keys: bool = True) -> DataFrame:
    """The first row of each key in the given order."""
    rows = df if keep_null_keys else df.where(all_of([F.col(k).isNotNull() for k in keys]))
    return rows.withColumn("__rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__rank = 1").drop("__rank")


def latest_versions(df: DataFrame, keys: list[str], newest_first: list[str], id_col: str = "id", keep_null_keys: bool = False) -> DataFrame:
    """The newest row of each key; rows with a null key are dropped unless asked for."""
    order = [F.desc_nulls_last(c) for c in newest_first] + [F.asc_nulls_last(id_col)]
    return first_of_each(df, keys, order, keep_null_keys)


def representatives(
    df: DataFrame,
    family: list[str],
    content: tuple[str, ...] = ("title", "abstract"),
    jurisdiction: str = "jurisdiction",
    preferred: tuple[str, ...] = ("WO", "EP", "US"),
    year: str = "publication_year",
    id_col: str = "id",
) -> DataFrame:
    """One row of each family: with content if any has it, of those a preferred office's, then the newest."""
    full = has_content(*content)
    order = [full.desc(), (full & F.coalesce(F.col(jurisdiction).isin(*preferred), F.lit(False))).desc(), F.desc_nulls_last(year), F.asc_nulls_last(id_col)]
    return first_of_each(df, family, order, keep_null_keys=False)


def group_key(family: str = "family_id", id_col: str = "id") -> Column:
    """The family, or the row's own id where it has none."""
    return F.coalesce(F.col(family).cast("string"), F.col(id_col).cast("string"))


def unseen(df: DataFrame, known: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose key is not known yet; a null key counts as known if a null is."""
    existing = known.select(F.col(key).alias("__known"))
    return df.join(existing, F.col(key).eqNullSafe(F.col("__known")), "left_anti")


def seen(df: DataFrame, known: DataFrame, key: str = "id") -> DataFrame:
    existing = known.select(F.col(key).alias("__known"))
    return df.join(existing, F.col(key).eqNullSafe(F.col("__known")), "left_semi")


def split_known(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """All rows, with ``is_known``: one join serves both sides of the split."""
    marks = known.select(F.col(key).alias("__known")).distinct().withColumn("__mark", F.lit(True))
    joined = df.join(marks, F.col(key).eqNullSafe(F.col("__known")), "left")
    return joined.withColumn("is_known", F.coalesce("__mark", F.lit(False))).drop("__known", "__mark")


def superseded(stored: DataFrame, incoming: DataFrame, keys: list[str], year: str = "publication_year") -> DataFrame:
    """All rows of both, as structs ``stored`` or ``incoming``, with ``passes``: whether a stored row stays, an incoming one enters.

    An incoming row enters unless the key's newest stored year is as new; stored rows of a key go
    when an incoming row is newer than all of them.  Null keys match null.  One union and one shuffle serve both sides.
    """
    rows = None
    for side, df in (("stored", stored), ("incoming", incoming)):
        other = {"stored": incoming, "incoming": stored}[side]
        own = F.struct(*[F.col(f"`{c}`") for c in df.columns])
        columns = {side: own, ({"stored", "incoming"} - {side}).pop(): F.lit(None).cast(other.schema)}
        part = df.select(*[F.col(k).alias(f"__k{n}") for n, k in enumerate(keys)], F.col(year).alias("__year"), F.lit(side == "stored").alias("__there"), *[columns[c].alias(c) for c in ("stored", "incoming")])
        rows = part if rows is None else rows.unionByName(part)
    key = Window.partitionBy(*[f"__k{n}" for n in range(len(keys))])
    there = F.col("__there")
    rows = rows.withColumns({"__old": F.max(F.when(there, F.col("__year"))).over(key), "__new": F.max(F.when(~there, F.col("__year"))).over(key), "__any": F.max(there).over(key)})
    stays, enters = ~F.coalesce(F.col("__new") > F.col("__old"), F.lit(False)), ~F.col("__any") | F.coalesce(F.col("__year") > F.col("__old"), F.lit(False))
    return rows.select(F.when(there, F.col("stored")).alias("stored"), F.when(~there, F.col("incoming")).alias("incoming"), F.when(there, stays).otherwise(enters).alias("passes"))


def supersede(stored: DataFrame, incoming: DataFrame, keys: list[str], year: str = "publication_year") -> tuple[DataFrame, DataFrame]:
    """(stored rows that stay, incoming rows that enter), see :func:`superseded`."""
    rows = superseded(stored, incoming, keys, year).where("passes")
    return tuple(rows.where(F.col(side).isNotNull()).select(f"{side}.*") for side in ("stored", "incoming"))


def propagate(members: DataFrame, decisions: DataFrame, key: str, columns: list[str], order: list[Column] | None = None, how: str = "left") -> DataFrame:
    """Give all members of a group the decision of the group; of several decisions the first in order."""
    picked = first_of_each(decisions, [key], order) if order else decisions
    return members.drop(*columns).join(picked.where(F.col(key).isNotNull()).select(key, *columns), key, how)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc(column))


def top_keys(df: DataFrame, keys: list[str], amount: str, k: int = 500) -> DataFrame:
    """The k keys of largest sum, exactly; rows with a null key are left out, ties go to the smaller key."""
    rows = df.where(all_of([F.col(c).isNotNull() for c in keys]))
    return rows.groupBy(*keys).agg(F.sum(amount).alias("total")).orderBy(F.desc("total"), *[F.asc(c) for c in keys]).limit(k)
