"""Structured verdicts of a model service: requests, result parsing, pillars, propagation."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import as_bool, message
from .curate import first_of_each

SCOPE_FIELDS = T.StructType(
    [
        T.StructField("scope", T.StringType()),
        T.StructField("confidence", T.DoubleType()),
        *[T.StructField(f, T.StringType()) for f in ("plant_based", "fermentation", "cultivated", "cross_cutting")],
    ]
)
#: Answers to older requests have the longer names.
LABEL_FIELDS = T.StructType([T.StructField(f, T.StringType()) for f in ("primary", "secondary", "primary_category", "secondary_category")])


def scope_tool(name: str = "record_scope") -> dict:
    """JSON schema of the scoping verdict."""
    flags = ("plant_based", "fermentation", "cultivated", "cross_cutting")
    return {
        "name": name,
        "description": "Record whether the document is in scope, how sure that is, and the technologies it is about.",
        "input_schema": {
            "type": "object",
            "properties": {"scope": {"type": "string", "enum": ["in", "out"]}, "confidence": {"type": "integer", "minimum": 1, "maximum": 7}} | {f: {"type": "boolean"} for f in flags},
            "required": ["scope", "confidence", *flags],
        },
    }


def label_tool(name: str, description: str, categories: list[str], secondary: bool = True) -> dict:
    """JSON schema of a label verdict."""
    fields = {f: {"type": "string", "enum": categories} for f in ("primary", *(["secondary"] if secondary else []))}
    return {"name": name, "description": description, "input_schema": {"type": "object", "properties": fields, "required": list(fields)}}


def tool_value(tool: dict, text: Column | None = None) -> Column:
    """The tool as a struct; ``text`` may give each row the JSON of another tool of the same shape."""
    literal = json.dumps(tool)
    return F.from_json(F.lit(literal) if text is None else text, F.schema_of_json(F.lit(literal)))


def requests(
    df: DataFrame, tool: str | dict, model: str, max_tokens: int, prompt: Column | str, title: str = "title", body: str = "abstract", id_col: str = "id", tool_text: Column | None = None
) -> DataFrame:
    """custom_id and the request's parameters, one row for each document; ids travel as they are.

    A tool given as its schema is sent along, a tool given by name only is chosen.  ``tool_text`` is JSON of
    the same shape where the schema differs from row to row.
    """
    name = tool if isinstance(tool, str) else tool["name"]
    sent = [] if isinstance(tool, str) else [F.array(tool_value(tool, tool_text)).alias("tools")]
    prompt = F.lit(prompt) if isinstance(prompt, str) else prompt
    params = F.struct(
        F.lit(model).alias("model"),
        F.lit(max_tokens).alias("max_tokens"),
        F.lit(0).alias("temperature"),
        F.array(F.struct(F.lit("text").alias("type"), prompt.alias("text"), F.struct(F.lit("ephemeral").alias("type")).alias("cache_control"))).alias("system"),
        *sent,
        F.struct(F.lit("tool").alias("type"), F.lit(name).alias("name")).alias("tool_choice"),
        F.array(F.struct(F.lit("user").alias("role"), message(title, body).alias("content"))).alias("messages"),
    )
    return df.select(F.col(id_col).alias("custom_id"), F.to_json(params).alias("params"))


def status(results: DataFrame, required: str, parsed: str = "parsed") -> Column:
    """ok, parse_error, or the result's own type; the required field tells malformed from good JSON."""
    return F.when(F.col("result_type") != "succeeded", F.col("result_type")).when(F.col(f"{parsed}.{required}").isNotNull(), "ok").otherwise("parse_error")


def parse_scope(results: DataFrame) -> DataFrame:
    """custom_id, result_type, stop_reason, payload to typed verdict columns with ``pillar_LLM``."""
    parsed = results.withColumn("parsed", F.from_json("payload", SCOPE_FIELDS))
    out = parsed.select(
        F.col("custom_id").alias("id"),
        F.when(F.col("result_type") == "succeeded", F.col("parsed.scope")).alias("scope_LLM"),
        F.when(F.col("result_type") == "succeeded", F.col("parsed.confidence")).alias("confidence_LLM"),
        *[F.when(F.col("result_type") == "succeeded", as_bool(F.col(f"parsed.{f}"))).alias(f"{f}_LLM") for f in ("plant_based", "fermentation", "cultivated", "cross_cutting")],
        status(parsed, "scope").alias("status_LLM"),
        F.when(F.col("result_type") == "succeeded", F.col("stop_reason")).alias("stop_reason_LLM"),
    )
    return out.withColumn("pillar_LLM", F.when(F.col("status_LLM") == "ok", pillar_of("plant_based_LLM", "fermentation_LLM", "cultivated_LLM", "cross_cutting_LLM")))


def pillar_of(plant: str, fermentation: str, cultivated: str, cross: str) -> Column:
    """CC for several flags or only the cross-cutting one, else the one flag's pillar, else NA; null is no flag."""
    p, f, c, x = (F.coalesce(F.col(k), F.lit(False)) for k in (plant, fermentation, cultivated, cross))
    n = p.cast("int") + f.cast("int") + c.cast("int")
    return F.when((n > 1) | (x & (n == 0)), "CC").when(p, "PB").when(f, "F").when(c, "CM").otherwise("NA")


def normalised(value: Column, categories: list[str]) -> Column:
    """The category that equals the value but for case and surrounding space; null if none does."""
    table = F.create_map(*[F.lit(x) for c in dict.fromkeys(categories) for x in (c.strip().lower(), c)])
    return F.try_element_at(table, F.lower(F.trim(value)))


def parse_labels(results: DataFrame, categories: Column | list[str], prefix: str) -> DataFrame:
    """Primary and secondary label; an unknown primary is a parse error, an unknown secondary is null."""
    parsed = results.withColumn("parsed", F.from_json("payload", LABEL_FIELDS))
    good = F.col("result_type") == "succeeded"
    primary = F.when(good, normalised(F.coalesce("parsed.primary", "parsed.primary_category"), categories))
    return parsed.select(
        F.col("custom_id").alias("id"),
        primary.alias(f"primary_{prefix}_LLM"),
        F.when(primary.isNotNull(), normalised(F.coalesce("parsed.secondary", "parsed.secondary_category"), categories)).alias(f"secondary_{prefix}_LLM"),
        F.when(~good, F.col("result_type")).when(primary.isNotNull(), "ok").otherwise("parse_error").alias(f"{prefix}_status_LLM"),
        F.when(good, F.col("stop_reason")).alias(f"{prefix}_stop_reason_LLM"),
    )


def to_family(members: DataFrame, verdicts: DataFrame, representatives: DataFrame, columns: list[str], family: str = "family_id") -> DataFrame:
    """Verdicts on representatives for all members of their families; rows without one keep what they had."""
    by_family = representatives.select("id", family).join(verdicts, "id").where(F.col(family).isNotNull())
    one = first_of_each(by_family, [family], [F.asc("id")]).select(family, *[F.col(c).alias(f"__new_{c}") for c in columns], F.lit(True).alias("__hit"))
    joined = members.join(one, family, "left")
    new = {c: F.when(F.col("__hit").isNotNull(), F.col(f"__new_{c}")).otherwise(F.col(c) if c in members.columns else F.lit(None)) for c in columns}
    return joined.withColumns(new).drop("__hit", *[f"__new_{c}" for c in columns])
