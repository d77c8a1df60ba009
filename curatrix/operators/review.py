"""Review rules as data: first match wins, then overrides; what no rule decides goes to people."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import differs, holds

MANUAL = "manual_review"


def first_match(rules: list[tuple[Column, object]], otherwise) -> Column:
    """The value of the first rule that holds; null conditions do not hold."""
    out = None
    for condition, value in rules:
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(holds(condition), value) if out is None else out.when(holds(condition), value)
    return F.lit(otherwise) if out is None else out.otherwise(otherwise)


def patent_rules() -> list[tuple[Column, str]]:
    """The decision table for families of patents."""
    scope, sure, chance, pillar = F.col("scope_LLM"), F.col("confidence_LLM"), F.col("proba_scope"), F.col("pred_pillar")
    return [
        ((scope == "NA") & (F.col("pred_combined") == "in"), MANUAL),
        ((scope == "in") & (sure >= 5), "in"),
        ((sure <= 4) & (chance > 0.8) & differs("pred_pillar", "NA"), "in"),
        ((scope == "out") & (sure == 2) & (chance < 0.6) & (pillar == "NA"), "out"),
        ((scope == "out") & (sure == 1) & (chance < 0.8), "out"),
    ]


def review_patents(df: DataFrame) -> DataFrame:
    """scope_curated and pillar_curated by the table; a negative classifier overrides it."""
    scope = F.when(holds(F.col("pred_combined") == "out"), "out").otherwise(first_match(patent_rules(), MANUAL))
    known = F.coalesce(F.nullif("pillar_LLM", F.lit("NA")), F.nullif("pred_pillar", F.lit("NA")))
    return df.withColumn("scope_curated", scope).withColumn("pillar_curated", F.when(F.col("scope_curated") != "out", known))


def review_publications(df: DataFrame) -> DataFrame:
    """The verdict is inherited where it is confident, or borderline and the classifier agrees."""
    scope, sure, pillar = F.col("scope_LLM"), F.col("confidence_LLM"), F.col("pillar_LLM")
    named = differs("pillar_LLM", "NA")
    inherit = (
        holds((scope == "in") & (sure > 4) & named)
        | holds((scope == "in") & (sure == 4) & named & (pillar == F.col("pred_pillar")))
        | holds((scope == "out") & (sure < 2) & (pillar == "NA"))
    )
    negative = holds(F.col("pred_combined") == "out")
    return df.withColumn("scope_curated", F.when(negative, "out").when(inherit, scope).otherwise(MANUAL)).withColumn(
        "pillar_curated", F.when(negative, None).when(inherit, pillar).otherwise(MANUAL)
    )


def split_for_review(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows for people, rows that are decided)."""
    return df.where(F.col("scope_curated") == MANUAL), df.where(differs("scope_curated", MANUAL) & F.col("scope_curated").isNotNull())


def unrecognised(df: DataFrame, pillars: tuple[str, ...] = ("PB", "F", "CM", "CC")) -> DataFrame:
    """In-scope rows whose pillar is none of the recognised ones; there should be none."""
    return df.where(holds(F.col("scope_curated") == "in") & ~holds(F.col("pillar_curated").isin(*pillars)))
