"""Drops structurally broken messages from conversations; no shuffle, no explode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionloom.functions.plan import fenced
from sessionloom.functions.text import filled

# Commands whose nonzero exit is normal.
NOISY = ("grep", "ps aux |", "lsof -i :", "sleep ", "jobs -l", "curl")


def failed_command(content: Column) -> Column:
    """Whether a tool result is surely a failed shell command: a nonzero exit code of a command
    that isn't noisy, or an unknown command, or a missing file. Null is no failure."""
    low = F.lower(content)
    code = F.regexp_extract(content, r"(?i)Exit Code:\s*([0-9]+)", 1)
    noisy = F.lit(False)
    for word in NOISY:
        noisy = noisy | low.contains(word)
    return F.coalesce((code.rlike("[1-9]") & ~noisy) | content.rlike("(?i)command not found") | content.rlike("(?i)no such file or directory"), F.lit(False))


def _calls(m: Column) -> Column:
    return F.coalesce(F.size(m["tool_calls"]), F.lit(0)) > 0


def keep_message(m: Column) -> Column:
    role = m["role"]
    return F.when(role.isin("system", "user"), True).when(role == "assistant", filled(m["content"]) | _calls(m)).when(role == "tool", ~failed_command(m["content"])).otherwise(False)


def without_orphans(messages: Column) -> Column:
    """Strips calls without a result of their id anywhere in the record; an assistant turn that is
    left with neither call nor text goes. Results without a call stay."""
    results = F.transform(F.filter(messages, lambda m: m["role"] == "tool"), lambda m: F.coalesce(m["tool_call_id"], F.lit("")))

    def strip(m: Column) -> Column:
        kept = F.filter(m["tool_calls"], lambda c: F.array_contains(results, F.coalesce(c["id"], F.lit(""))))
        return F.when((m["role"] == "assistant") & _calls(m), m.withField("tool_calls", F.when(F.size(kept) > 0, kept))).otherwise(m)

    def stays(m: Column) -> Column:
        return ~((m["role"] == "assistant") & _calls(m)) | filled(m["content"]) | F.exists(m["tool_calls"], lambda c: F.array_contains(results, F.coalesce(c["id"], F.lit(""))))

    return F.transform(F.filter(messages, stays), strip)


def clean(df: DataFrame, remove_orphaned: bool = True) -> DataFrame:
    """messages cleaned, and _cleaned_stats: the number of removed tool results, null if none.
    A null messages column is an empty conversation; null content counts as absent."""
    messages = F.coalesce(F.col("messages"), F.array().cast(df.schema["messages"].dataType))
    removed = F.size(F.filter(messages, lambda m: (m["role"] == "tool") & failed_command(m["content"])))
    kept = F.filter(messages, keep_message)
    out = df.withColumn("_cleaned_stats", F.when(removed > 0, F.struct(removed.alias("removed_tool_results"))))
    out = out.withColumn("messages", fenced(kept))
    return out.withColumn("messages", without_orphans(F.col("messages"))) if remove_orphaned else out
