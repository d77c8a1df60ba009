"""Label types, automatic values, and assembly of the labelled table."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.nulls import all_of, differs
from ..functions.text import as_json
from .curate import group_key, representatives

# The categories that verdicts are checked against.
PATENT_CATEGORIES = {
    "PB": ["Crop development", "Strain development", "Ingredient optimisation", "End product formulation", "Texturization methods", "Food safety & quality", "Health & nutrition", "Other"],
    "F": ["Feedstocks", "Target molecule selection", "Strain development", "Bioprocess design", "Ingredient optimisation", "End product formulation", "Texturization methods", "Food safety & quality", "Health & nutrition", "Other"],
    "CM": ["Cell line development", "Cell culture media", "Bioprocess design", "Scaffolding", "End product formulation", "Food safety & quality", "Health & nutrition", "Other"],
    "CC": ["Bioprocess design", "Scaffolding", "Ingredient optimisation", "End product formulation", "Texturization methods", "Food safety & quality", "Health & nutrition", "Other"],
}
PUBLICATION_EXTRA = ["Consumer & market research", "Impact assessments"]
END_PRODUCTS = ["Meat", "Fish and seafood", "Milk and milk proteins", "Yoghurt and fermented dairy", "Cheese", "Cream and ice cream", "Agnostic", "Chocolate, desserts, and confectionery", "Eggs and egg proteins", "Cross-cutting", "Spreads, sauces, and condiments", "Dairy"]
INGREDIENTS = ["Isolates, concentrates, and flours", "Emulsions, gels, and binders", "N/A", "Flavours and aromas", "Colours", "Fats and oils"]
SUBPILLARS = ["BF", "PF", "NA"]
PILLARS = ("PB", "F", "CM", "CC")


@dataclass(frozen=True)
class LabelType:
    """What one kind of label asks, of which rows, and where it goes."""

    name: str
    output: str
    categories: dict[str, list[str]] = field(hash=False)  # by pillar, or for all under ""
    secondary: bool = True
    only_pillars: tuple[str, ...] = ()
    automatic: str | None = None

    @property
    def by_pillar(self) -> bool:
        return "" not in self.categories

    def categories_of(self, pillar: str) -> list[str]:
        return self.categories[pillar if self.by_pillar else ""]


PATENT_LABELS = (
    LabelType("category", "research_category", PATENT_CATEGORIES),
    LabelType("endproduct", "end_product", {"": END_PRODUCTS}),
    LabelType("ingredient", "ingredient", {"": INGREDIENTS}),
    LabelType("subpillar", "subpillar", {"": SUBPILLARS}, secondary=False, only_pillars=("F",), automatic="NA"),
)
PUBLICATION_LABELS = (LabelType("category", "research_category", {p: c[:-1] + PUBLICATION_EXTRA + c[-1:] for p, c in PATENT_CATEGORIES.items()}),)


def eligible(df: DataFrame, kind: LabelType) -> DataFrame:
    """In-scope rows of a recognised pillar whose label is not there yet."""
    rows = df.where((F.col("scope_curated") == "in") & F.col("pillar_curated").isin(*PILLARS))
    done = f"{kind.name}_status_LLM"
    return rows.where(differs(done, "ok")) if done in df.columns else rows


def automatic(df: DataFrame, kind: LabelType) -> DataFrame:
    """Rows outside the label's pillars get its automatic value, without a request."""
    if not kind.only_pillars:
        return df.limit(0)
    rows = df.where(~F.col("pillar_curated").isin(*kind.only_pillars))
    return rows.withColumns({f"primary_{kind.name}_LLM": F.lit(kind.automatic), f"{kind.name}_status_LLM": F.lit("ok")})


def to_ask(df: DataFrame, kind: LabelType) -> DataFrame:
    """One representative of each family and pillar among the rows that need a request."""
    rows = df.where(F.col("pillar_curated").isin(*kind.only_pillars)) if kind.only_pillars else df
    return representatives(rows.withColumn("group_key", group_key()), ["group_key", "pillar_curated"])


def spread(df: DataFrame, answers: DataFrame, columns: list[str]) -> DataFrame:
    """Answers on representatives for all members of their family and pillar."""
    keyed = df.withColumn("group_key", group_key())
    return keyed.join(answers.select("group_key", "pillar_curated", *columns), ["group_key", "pillar_curated"]).drop("group_key")


def assemble(classified: DataFrame, labelled_ids: DataFrame | None, kinds: tuple[LabelType, ...], drop: tuple[str, ...] = ()) -> DataFrame:
    """Fully labelled rows that are not in the labelled table yet, as they are exported.

    Working columns go, primary labels take their output names, nested values become JSON.
    """
    done: list[Column] = [F.col(f"{k.name}_status_LLM") == "ok" for k in kinds]
    rows = classified.where((F.col("scope_curated") == "in") & all_of(done))
    if labelled_ids is not None:
        rows = rows.join(labelled_ids.select("id"), "id", "left_anti")
    working = {f"{a}{k.name}{b}" for k in kinds for a, b in (("secondary_", "_LLM"), ("", "_status_LLM"), ("", "_stop_reason_LLM"))}
    rows = rows.drop(*working, *drop).withColumnsRenamed({f"primary_{k.name}_LLM": k.output for k in kinds})
    return rows.select(*[as_json(f.name).alias(f.name) if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)) else F.col(f.name) for f in rows.schema])
