"""Survivors of the score filter, formatted for training."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionloom.functions.text import strip, valid_json


def keep_scored(df: DataFrame, min_score: float = 0.5) -> DataFrame:
    """Rows whose rounded score reaches the bound; a missing score is 0."""
    return df.where(F.coalesce(F.col("score"), F.lit(0.0)) >= F.lit(float(min_score)))


def _arguments(c: Column) -> Column:
    """Arguments as a JSON value: as they are written where that is valid JSON, else as a string."""
    text = c["function"]["arguments"]
    return F.when(valid_json(text), strip(text)).otherwise(_quoted(text))


def _quoted(text: Column) -> Column:
    return F.when(text.isNotNull(), F.regexp_extract(F.to_json(F.struct(text.alias("v"))), r'(?s)^\{"v":(.*)\}$', 1))


def _field(name: str, value: Column) -> Column:
    return F.when(value.isNotNull(), F.concat(F.lit(f'"{name}":'), value))


def _object(*fields: Column) -> Column:
    return F.concat(F.lit("{"), F.array_join(F.array_compact(F.array(*fields)), ","), F.lit("}"))


def _call_json(c: Column) -> Column:
    function = _object(_field("name", _quoted(c["function"]["name"])), _field("arguments", _arguments(c)))
    return _object(_field("id", _quoted(c["id"])), _field("type", _quoted(c["type"])), _field("function", F.when(c["function"].isNotNull(), function)))


def message_json(m: Column, tools: Column | None = None) -> Column:
    """One message as JSON text, absent fields left out, arguments as values."""
    calls = F.when(F.size(m["tool_calls"]) > 0, F.concat(F.lit("["), F.array_join(F.transform(m["tool_calls"], _call_json), ","), F.lit("]")))
    flag = F.when(m["is_error"].isNotNull(), F.when(m["is_error"], "true").otherwise("false"))
    fields = [_field("role", _quoted(m["role"])), _field("content", _quoted(m["content"])), _field("name", _quoted(m["name"])), _field("tool_call_id", _quoted(m["tool_call_id"])), _field("is_error", flag), _field("tool_calls", calls)]
    return _object(*fields, *([_field("tools", tools)] if tools is not None else []))


def format_for_training(df: DataFrame) -> DataFrame:
    """messages become array<string> of JSON, the first one carrying the tools; the tools and
    metadata columns and internal fields go, so every row has one uniform schema."""
    kind = dict(df.dtypes).get("tools", "")
    tools = F.col("tools") if kind == "string" else F.to_json("tools") if kind else F.lit(None).cast("string")
    tools = F.when(~F.coalesce(tools, F.lit("[]")).isin("[]", "", "null"), tools)
    out = df.withColumn("messages", F.transform("messages", lambda m, i: message_json(m, F.when(i == 0, tools))))
    return out.drop("tools", "metadata", "_cleaned_stats", "_link")
