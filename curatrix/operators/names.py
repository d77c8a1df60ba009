"""Organisation names: a map of known variants, then the nearest entry of a company list.

A weighted ratio of at least 95 can only come from the plain ratio or from one name's tokens being
among the other's, as the partial variants are scaled to 90 at most.  Candidates are therefore found
by the rarest token of the smaller set, so a frequent token brings names together only if they have no rarer one, or by a
shared part of the name: two strings at an indel ratio of ``cutoff`` differ in few enough
edits that, cut into one part more than those, some part of the shorter is in the longer unchanged,
near its place.  Pairs whose lengths rule such a score out are dropped before they are scored.  Only distinct names are
compared; scores are computed in batches.
"""

from __future__ import annotations

import math
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import fold_accents
from ..sources import scratch


def mapped(name: Column, known: DataFrame, df: DataFrame, column: str) -> DataFrame:
    """``column`` of ``df`` by the last entry of the map (name, clean, ordinal), upper case."""
    last = known.groupBy("name").agg(F.max_by("clean", "ordinal").alias("__clean"))
    named = df.withColumn("__raw", name)
    joined = named.join(last.withColumnRenamed("name", "__known"), F.col("__raw") == F.col("__known"), "left")
    return joined.withColumn(column, F.upper(F.coalesce("__clean", "__raw"))).drop("__raw", "__known", "__clean")


def map_lists(df: DataFrame, column: str, known: DataFrame, output: str, id_col: str = "id") -> DataFrame:
    """A list column by the map: null stays null, an empty list stays empty, order is kept."""
    flat = df.select(id_col, F.posexplode(column).alias("__at", "__name"))
    clean = mapped(F.col("__name"), known, flat, "__value")
    lists = clean.groupBy(id_col).agg(F.transform(F.array_sort(F.collect_list(F.struct("__at", "__value"))), lambda x: x["__value"]).alias("__list"))
    return df.join(lists, id_col, "left").withColumn(output, F.when(F.col(column).isNull(), None).otherwise(F.coalesce("__list", F.array().cast("array<string>")))).drop("__list")


def positioned(df: DataFrame, output: str = "position") -> DataFrame:
    """``df``, as it is read from files, with each row's place: file, start of the split, and order within it.

    Splits of a file can be read in any order; their starts tell the order.
    """
    return df.withColumn(output, F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("row")))


def ordered_union(*columns: tuple[DataFrame, str, str], output: str = "company") -> DataFrame:
    """Distinct values of several columns (frame, column, position) with ``ordinal``, where each is met first.

    All of the first column come before those of the second.  Nulls are left out.  Positions are
    compared, never numbered through, so there is one minimum a value and no global order.
    """
    rows = None
    for n, (df, column, position) in enumerate(columns):
        part = df.select(F.col(column).cast("string").alias(output), F.struct(F.lit(n).alias("column"), F.col(position).alias("position")).alias("ordinal")).where(F.col(output).isNotNull())
        rows = part if rows is None else rows.unionByName(part)
    return rows.groupBy(output).agg(F.min("ordinal").alias("ordinal"))


def prepared(text: str) -> str:
    """Lower case, everything but letters and digits a space, trimmed."""
    return re.sub(r"[\W_]", " ", text.lower()).strip()


def common_length(a: str, b: str) -> int:
    """Length of a longest common subsequence, by bits."""
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    row = (1 << len(a)) - 1
    for c in b:
        u = row & masks.get(c, 0)
        row = (row + u) | (row - u)
    return len(a) - (row & ((1 << len(a)) - 1)).bit_count()


def ratio(a: str, b: str) -> float:
    """100 x (1 - insertions and deletions / summed length); two empty texts score 0."""
    return 200.0 * common_length(a, b) / (len(a) + len(b)) if a and b else 0.0


def token_ratio(a: str, b: str) -> float:
    """The better of sorted-token and token-set ratio."""
    x, y = a.split(), b.split()
    sa, sb = set(x), set(y)
    both, only_a, only_b = (" ".join(sorted(s)) for s in (sa & sb, sa - sb, sb - sa))
    if both and (not only_a or not only_b):
        return 100.0
    left, right = f"{both} {only_a}".strip(), f"{both} {only_b}".strip()
    parts = [ratio(" ".join(sorted(x)), " ".join(sorted(y))), ratio(left, right)]
    if both:
        parts += [ratio(both, left), ratio(both, right)]
    return max(parts)


def weighted_ratio(a: str, b: str) -> float:
    """Plain ratio, or 0.95 of the token ratio for names of similar length; partial matches stay below 95."""
    if not a or not b:
        return 0.0
    best = ratio(a, b)
    if max(len(a), len(b)) < 1.5 * min(len(a), len(b)):
        best = max(best, 0.95 * token_ratio(a, b))
    return best


@F.pandas_udf(T.DoubleType())
def score(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([weighted_ratio(x, y) for x, y in zip(a, b, strict=True)])


def prepare(folded: Column) -> Column:
    """The same of texts that are ASCII."""
    return F.trim(F.regexp_replace(F.lower(folded), "[^a-z0-9]", " "))


def name_blocks(cutoff: float, grown: bool):
    """Blocking keys of prepared names: parts of the name with their place.

    At ratio c and length n a partner has n - d to n + d characters, d = 2n(1 - c) / c rounded up; the shorter name is cut into
    d + 1 parts, of which one survives in place, moved by d at most.  ``grown`` gives all moves.
    """

    @F.pandas_udf("array<string>")
    def keys(names: pd.Series) -> pd.Series:
        c = cutoff / 100

        def of(s: str | None) -> list[str]:
            if not s:
                return []
            out = set()
            if grown:
                # of any shorter length n, its parts at all moves that the edits allow
                n, low = len(s), math.ceil(len(s) * c / (2 - c))
                for m in range(max(1, low), n + 1):
                    d = math.floor(2 * m * (1 - c) / c)
                    if n - m > d:
                        continue
                    for k in range(d + 1):
                        a, z = k * m // (d + 1), (k + 1) * m // (d + 1)
                        out.update(f"{m}.{k}.{s[x : x + z - a]}" for x in range(max(0, a - d), min(n - (z - a), a + d) + 1) if z > a)
            else:
                m = len(s)
                d = math.floor(2 * m * (1 - c) / c)
                out.update(f"{m}.{k}.{s[k * m // (d + 1) : (k + 1) * m // (d + 1)]}" for k in range(d + 1))
            return list(out)

        return names.map(of)

    return keys


def _written(df: DataFrame) -> DataFrame:
    path = scratch.folder(df.sparkSession, "names")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def nearest_company(names: DataFrame, companies: DataFrame, name: str = "name", company: str = "company", cutoff: float = 95.0, shortest: float = 0.5) -> DataFrame:
    """name, match, score: the best company of each distinct name, or the name itself.

    The first of equal scores wins (by ``ordinal`` of the companies); a match shorter than half the
    name is refused; null names have no row.
    """
    left = names.select(F.col(name).alias("__name")).where("__name is not null").distinct().withColumn("__a", prepare(fold_accents("__name")))
    right = companies.select(F.col(company).alias("__company"), F.col("ordinal").alias("__ordinal")).where("__company is not null")
    right = right.groupBy("__company").agg(F.min("__ordinal").alias("__ordinal")).withColumn("__b", prepare(fold_accents("__company")))
    if cutoff < 95:
        raise ValueError("below 95 partial matches count, which are not searched for")
    # distinct names are prepared once, as all that follows comes back to them
    left, right = (_written(df.withColumn("__tokens", F.array_distinct(F.filter(F.split(c, " "), lambda w: w != "")))) for df, c in ((left, "__a"), (right, "__b")))
    seen = left.select(F.explode("__tokens").alias("__token")).unionByName(right.select(F.explode("__tokens").alias("__token"))).groupBy("__token").agg(F.count("*").alias("__n"))

    def blocks(df: DataFrame, name: str, prepared: str, tags: str) -> DataFrame:
        """Keys under which names meet: rarest token, all tokens, parts of the shorter and of the longer name."""
        tagged = lambda tag, keys: F.transform(keys, lambda k: F.concat(F.lit(tag), k))
        found = df.select(name, F.explode("__tokens").alias("__token")).join(seen, "__token")
        rare = found.groupBy(name).agg(F.concat(F.lit(tags[0]), F.min_by("__token", F.struct("__n", "__token"))).alias("__block"))
        keys = F.concat(tagged(tags[1], F.col("__tokens")), tagged(tags[2], name_blocks(cutoff, False)(prepared)), tagged(tags[3], name_blocks(cutoff, True)(prepared)))
        return df.select(name, F.explode(keys).alias("__block")).unionByName(rare)

    # either side may be the smaller or shorter one: what is rarest or short on one side meets what is whole or long on the other
    pairs = blocks(left, "__name", "__a", "wWsl").join(blocks(right, "__company", "__b", "Wwls"), "__block").select("__name", "__company")
    pairs = pairs.distinct().join(left.select("__name", "__a"), "__name").join(right.select("__company", "__b", "__ordinal"), "__company")
    longer, shorter = F.greatest(F.length("__a"), F.length("__b")), F.least(F.length("__a"), F.length("__b"))
    # a plain ratio is 200 x the shorter length / both lengths at most, a token ratio needs similar lengths
    possible = (longer < 1.5 * shorter) | (200.0 * shorter / (longer + shorter) >= cutoff)
    scored = pairs.where(possible).withColumn("score", score("__a", "__b")).where(F.col("score") >= cutoff)
    best = scored.withColumn("__rank", F.row_number().over(Window.partitionBy("__name").orderBy(F.desc("score"), "__ordinal"))).where("__rank = 1")
    ok = F.length("__company") >= F.length("__name") * shortest
    return left.join(best.select("__name", "__company", "score"), "__name", "left").select(
        F.col("__name").alias(name), F.when(F.coalesce(ok, F.lit(False)), F.col("__company")).otherwise(F.col("__name")).alias("match"), F.when(ok, F.col("score")).alias("score")
    )
