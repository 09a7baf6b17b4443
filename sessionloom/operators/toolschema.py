"""Tool descriptions inferred from the first call of each tool."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TYPE = T.StructType([T.StructField("type", T.StringType())])
_PARAMETERS = T.StructType([T.StructField("type", T.StringType()), T.StructField("properties", T.MapType(T.StringType(), _TYPE)), T.StructField("required", T.ArrayType(T.StringType()))])
_NAMES = {str: "string", bool: "boolean", int: "number", float: "number", list: "array", dict: "object"}


@F.pandas_udf(_PARAMETERS)
def parameters_of(arguments: pd.Series) -> pd.DataFrame:
    """Types by value (null counts as string), in the order written; required are arguments that
    aren't null and don't begin with an underscore. Runs once per distinct tool and session."""
    rows = []
    for text in arguments:
        try:
            doc = json.loads(text) if text else {}
        except (ValueError, RecursionError):
            doc = {}
        doc = doc if isinstance(doc, dict) else {}
        rows.append(("object", {k: {"type": _NAMES.get(type(v), "string")} for k, v in doc.items()}, [k for k, v in doc.items() if v is not None and not k.startswith("_")]))
    return pd.DataFrame(rows, columns=["type", "properties", "required"])


def tool_schema(name: Column, parameters: Column) -> Column:
    function = F.struct(name.alias("name"), F.concat(F.lit("Tool function: "), name).alias("description"), parameters.alias("parameters"))
    return F.struct(F.lit("function").alias("type"), function.alias("function"))


def first_schemas(calls: DataFrame, session: list[str], order: list[str]) -> DataFrame:
    """session + tools: one schema per tool of each session, by its first call, in order of first use.
    ``calls`` has the session's columns, the order's, name and arguments; nameless calls make none."""
    at = F.struct(*order)
    first = calls.where("name is not null and name <> ''").groupBy(*session, "name").agg(F.min_by("arguments", at).alias("arguments"), F.min(at).alias("at"))
    made = first.withColumn("tool", tool_schema(F.col("name"), parameters_of("arguments")))
    return made.groupBy(*session).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", F.struct("name").alias("k"), F.to_json("tool").alias("t")))), lambda x: x["t"]).alias("tools_json"))
