"""Checks formatted conversations against a chat template and a tokenizer."""

from __future__ import annotations

import json
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionloom.operators.format import format_for_training

RESULT = "tokens bigint, tool_calls bigint, has_tools boolean, error string"


def validate(df: DataFrame, make_counter: Callable[[], Callable[[list[dict], list | None], int]]) -> DataFrame:
    """The formatted records and what the check found: tokens, tool_calls, has_tools, and error, null
    where the template took the conversation.

    ``make_counter`` runs once per worker and gives a function (messages, tools) -> tokens
    that applies the template; what it raises becomes the row's error.
    """

    slim = format_for_training(df).withColumns({"id": F.coalesce("id", F.lit("unknown")), "messages": F.coalesce("messages", F.array().cast("array<string>"))}).drop("tokens", "tool_calls", "has_tools", "error")
    schema = T.StructType([*slim.schema.fields, *T._parse_datatype_string(RESULT).fields])

    def run(batches):
        count = make_counter()
        for batch in batches:
            found: list[list] = [[] for _ in range(4)]
            for texts in batch.column("messages").to_pylist():
                messages = [json.loads(t) for t in texts]
                tools = messages[0].pop("tools", None) if messages else None
                calls = sum(len(m.get("tool_calls") or []) for m in messages if m.get("role") == "assistant")
                tokens = error = None
                try:
                    tokens = count(messages, tools)
                except Exception as e:  # noqa: BLE001 - a template may raise anything
                    error = f"{type(e).__name__}: {e}"
                for col, v in zip(found, (tokens, calls, tools is not None, error)):
                    col.append(v)
            types = (pa.int64(), pa.int64(), pa.bool_(), pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(c, t) for c, t in zip(found, types)]], names=[*batch.schema.names, "tokens", "tool_calls", "has_tools", "error"])

    return slim.mapInArrow(run, schema)


def report(validated: DataFrame) -> DataFrame:
    """One row: totals, and the range and mean of tokens of what passed."""
    ok = F.col("error").isNull()
    return validated.agg(
        F.count("*").alias("total"), F.count(F.when(ok, 1)).alias("passed"), F.count(F.when(~ok, 1)).alias("failed"),
        F.count(F.when(F.col("tool_calls") > 0, 1)).alias("sessions_with_tools"), F.coalesce(F.sum("tool_calls"), F.lit(0)).alias("total_tool_calls"),
        F.min("tokens").alias("min_tokens"), F.max("tokens").alias("max_tokens"), F.avg("tokens").alias("avg_tokens"),
    )


def passed(validated: DataFrame) -> DataFrame:
    """The records the template took, with all their fields and without what the check added."""
    return validated.where("error is null").drop("tokens", "tool_calls", "has_tools", "error")


def failures(validated: DataFrame, n: int = 10) -> DataFrame:
    return validated.where("error is not null").select("id", "error", F.size("messages").alias("n_messages")).limit(n)
