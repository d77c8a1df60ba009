"""Exact train/test splits and folds, with strata, without sorting the rows or bringing a stratum to one task.

Rows are ordered by a 60-bit hash of (seed, id), ties by the id: a shuffle that depends on nothing else, so the
same rows are dealt alike in every run and on every cluster.  Ids tell rows apart: rows with one id
always go to the same side of a split.  Null strata are a stratum, null ids count as empty ones.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BITS, LEVEL = 60, 12
#: Rows of a stratum that are ranked together at most, where hashes allow it.
BUCKET_ROWS = 10_000


def hash_key(id_col: str, seed: int) -> Column:
    """The first 60 bits of an MD5 hash, as a number."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, BITS // 4), 16, 10).cast("long")


def _keyed(df: DataFrame, id_col: str, strata: str | None, seed: int) -> DataFrame:
    stratum = F.col(strata).cast("string") if strata else F.lit("all")
    return df.withColumns({"__stratum": stratum, "__key": hash_key(id_col, seed), "__id": F.coalesce(F.col(id_col).cast("string"), F.lit(""))})


def quotas(sizes: dict, test_size: float) -> dict:
    """Rows of each stratum for the test side: ceil(test_size * all) in all, in proportion, largest remainders first.

    Equal remainders go to the larger stratum, then by name, null first.
    """
    total = sum(sizes.values())
    # a product such as 0.2 * 15 may be just above a whole number
    wanted = min(total, math.ceil(round(test_size * total, 9)))
    out = {s: n * wanted // total for s, n in sizes.items()} if total else {}
    order = sorted(out, key=lambda s: (-(sizes[s] * wanted % total), -sizes[s], s is not None, s or ""))
    for s in order[: wanted - sum(out.values())]:
        out[s] += 1
    return out


def split(df: DataFrame, id_col: str, test_size: float = 0.2, strata: str | None = None, seed: int = 42, output: str = "is_test") -> DataFrame:
    """``df`` with a boolean: true for the rows of each stratum with the smallest hashes, as many as its quota.

    The hash at the cut is found by counting prefixes of hashes, twelve bits at a time and only among rows in the
    bucket at the cut, until that is small enough to be ranked.  Sizes and cuts are a row for each
    stratum; the rows themselves are only compared with their stratum's cut, without a shuffle.
    """
    if not 0 <= test_size <= 1:
        raise ValueError("test_size is a share")
    spark = df.sparkSession
    rows = _keyed(df.select(*dict.fromkeys([id_col, *([strata] if strata else [])])), id_col, strata, seed).select("__stratum", "__key", "__id").distinct()
    sizes = {r["__stratum"]: r["count"] for r in rows.groupBy("__stratum").count().collect()}  # a row for each stratum
    left = {s: n for s, n in quotas(sizes, test_size).items() if n}  # still to be found in the bucket
    prefix = dict.fromkeys(left, 0)
    shift = BITS
    largest = max((sizes[s] for s in left), default=0)

    def in_bucket() -> DataFrame:
        cuts = spark.createDataFrame([(s, prefix[s]) for s in left], "__s string, __prefix long")  # a row for each stratum
        return rows.join(F.broadcast(cuts), F.col("__stratum").eqNullSafe(F.col("__s")) & (F.shiftright("__key", shift) == F.col("__prefix")))

    while left and largest > BUCKET_ROWS and shift:
        found = in_bucket().groupBy("__stratum", F.shiftright("__key", shift - LEVEL).alias("p")).count()
        run = found.withColumn("before", F.sum("count").over(Window.partitionBy("__stratum").orderBy("p")) - F.col("count"))
        need = spark.createDataFrame(list(left.items()), "__s string, need long")
        at = run.join(F.broadcast(need), F.col("__stratum").eqNullSafe(F.col("__s"))).where("before < need and need <= before + count").collect()  # one row a stratum
        prefix = {r["__stratum"]: r["p"] for r in at}
        left = {r["__stratum"]: r["need"] - r["before"] for r in at}
        largest, shift = max(r["count"] for r in at), shift - LEVEL
    if left:
        ranked = in_bucket().withColumn("rank", F.row_number().over(Window.partitionBy("__stratum").orderBy("__key", "__id")))
        need = spark.createDataFrame(list(left.items()), "__n string, need long")
        cuts = ranked.join(F.broadcast(need), F.col("__stratum").eqNullSafe(F.col("__n"))).where("rank = need").select("__stratum", "__key", "__id").collect()
    else:
        cuts = []
    limits = spark.createDataFrame([tuple(r) for r in cuts], "__s string, __cut long, __last string")
    inside = (F.col("__key") < F.col("__cut")) | ((F.col("__key") == F.col("__cut")) & (F.col("__id") <= F.col("__last")))
    marked = _keyed(df, id_col, strata, seed).join(F.broadcast(limits), F.col("__stratum").eqNullSafe(F.col("__s")), "left")
    return marked.withColumn(output, F.coalesce(inside, F.lit(False))).select(*df.columns, output)


def ranks(df: DataFrame, id_col: str, strata: str | None = None, seed: int = 42, output: str = "rank") -> DataFrame:
    """``df`` with each row's place, from 0, in its stratum by hash.

    Hash ranges of some ``BUCKET_ROWS`` rows are counted first, which gives each range its first
    number; rows are then ranked within their range.  A stratum of any size is spread over all tasks.
    """
    keyed = _keyed(df, id_col, strata, seed)
    n = df.count()
    bits = max(0, math.ceil(math.log2(max(1, n / BUCKET_ROWS))))
    keyed = keyed.withColumn("__range", F.shiftright("__key", BITS - bits))
    counts = keyed.groupBy("__stratum", "__range").agg(F.count("*").alias("__n"))
    first = counts.select("__stratum", "__range", (F.sum("__n").over(Window.partitionBy("__stratum").orderBy("__range")) - F.col("__n")).alias("__first"))
    first = first.select(F.col("__stratum").alias("__s"), F.col("__range").alias("__r"), "__first")
    local = F.row_number().over(Window.partitionBy("__stratum", "__range").orderBy("__key", "__id")) - 1
    ranked = keyed.withColumn("__local", local).join(first, F.col("__stratum").eqNullSafe(F.col("__s")) & (F.col("__range") == F.col("__r")))
    return ranked.withColumn(output, (F.col("__first") + F.col("__local")).cast("long")).select(*df.columns, output)


def folds(df: DataFrame, id_col: str, strata: str | None = None, k: int = 5, seed: int = 42, output: str = "fold") -> DataFrame:
    """``df`` with a fold from 0: in every stratum folds differ by one row at most, and the larger ones come first."""
    if k < 2:
        raise ValueError("two folds at least are needed")
    ranked = ranks(df, id_col, strata, seed, "__rank")
    return ranked.withColumn(output, (F.col("__rank") % k).cast("int")).drop("__rank")
