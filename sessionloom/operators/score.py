"""Quality score of a conversation: saturating signals less ratio penalties.

All of it is column arithmetic over one nested row; nothing shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionloom.functions.plan import fenced, let
from sessionloom.functions.text import clamp, filled, round_half_even, thinking_count, token_estimate

# Where signals saturate and penalties begin and end.
LENGTH_TOKENS, CALLS, TOOLS = 8000.0, 20.0, 5.0
ERROR_FROM, ERROR_SPAN, EMPTY_FROM, EMPTY_SPAN = 0.30, 0.30, 0.10, 0.30
GOOD, MAYBE, CHATTER_CAP = 0.7, 0.5, 0.4
# Names of tools that read and that write files.
READ_TOOLS = ("read_file", "view", "cat", "read")
WRITE_TOOLS = ("write_file", "edit", "create_file", "str_replace_editor", "str_replace_based_edit_tool", "write")


def _of(messages: Column, role: str) -> Column:
    return F.filter(messages, lambda m: m["role"] == role)


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda a, x: a + x)


def _count(c: Column) -> Column:
    return F.size(c).cast("bigint")


def _counts(messages: Column, calls_type) -> Column:
    """The struct of counts over messages; each intermediate is bound once, which keeps plans small."""
    none = F.array().cast(calls_type)
    error = lambda m: F.coalesce(m["content"].contains("Error:"), F.lit(False)) | F.coalesce(m["is_error"], F.lit(False))
    empty = lambda m: ~filled(m["content"]) & (F.coalesce(F.size(m["tool_calls"]), F.lit(0)) <= 0)

    def of(x: Column) -> Column:
        ms, agent, tool, calls = x["ms"], x["agent"], x["tool"], x["calls"]
        names = F.transform(calls, lambda c: F.lower(F.coalesce(c["function"]["name"], F.lit(""))))
        called = F.array_distinct(F.transform(calls, lambda c: F.coalesce(c["id"], F.lit(""))))
        answered = F.array_distinct(F.transform(tool, lambda m: F.coalesce(m["tool_call_id"], F.lit(""))))
        heard = F.filter(ms, lambda m: m["role"].isin("user", "assistant", "tool"))
        return F.struct(
            _count(ms).alias("total_messages"),
            _total(F.transform(heard, lambda m: token_estimate(m["content"]))).alias("total_tokens"),
            _count(_of(ms, "user")).alias("user_turns"),
            _count(agent).alias("assistant_turns"),
            _count(calls).alias("tool_calls"),
            _count(tool).alias("tool_results"),
            _count(F.array_intersect(called, answered)).alias("complete_pairs"),
            _count(F.array_except(called, answered)).alias("incomplete_tool_chains"),
            _total(F.transform(agent, lambda m: thinking_count(m["content"]).cast("bigint"))).alias("thinking_tags"),
            _count(F.filter(tool, error)).alias("tool_error_count"),
            _count(F.filter(agent, empty)).alias("truly_empty_assistant"),
            F.array_sort(F.array_distinct(F.filter(names, lambda n: n != ""))).alias("tools_used"),
            F.exists(names, lambda n: n.isin(*READ_TOOLS)).alias("reads"),
            F.exists(names, lambda n: n.isin(*WRITE_TOOLS)).alias("writes"),
        )

    def parts(ms: Column) -> Column:
        calls = F.flatten(F.transform(_of(ms, "assistant"), lambda m: F.coalesce(m["tool_calls"], none)))
        return F.struct(ms.alias("ms"), _of(ms, "assistant").alias("agent"), _of(ms, "tool").alias("tool"), calls.alias("calls"))

    return let(messages, lambda ms: let(parts(ms), of))


def _said(df: DataFrame) -> Column:
    return F.coalesce(F.col("messages"), F.array().cast(df.schema["messages"].dataType))


def metrics(df: DataFrame) -> DataFrame:
    """df + m, a struct of counts over messages. Null content is empty, null messages are none."""
    return df.withColumn("m", fenced(_counts(_said(df), _calls_type(df))))


def _calls_type(df: DataFrame):
    return df.schema["messages"].dataType.elementType["tool_calls"].dataType


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(0.0)


def evaluate(df: DataFrame, min_turns: int = 2, min_tokens: int = 1000) -> DataFrame:
    """Adds session_id, score, label, reasons, metrics, tools_used and tool_count.

    Fewer than ``min_turns`` messages (of any role) or ``min_tokens`` tokens score 0; no
    tool call caps the score. The label follows the score before it is rounded.
    """
    base = [c for c in df.columns if c not in ("session_id", "score", "label", "reasons", "metrics", "tools_used", "tool_count")]
    d = df.withColumn("_e", fenced(let(_counts(_said(df), _calls_type(df)), lambda m: let(_signals(m), lambda s: let(_raw_score(m, s, min_turns, min_tokens), lambda x: _result(m, s, x, min_turns, min_tokens))))))
    e = F.col("_e")
    return d.select(
        *base, F.coalesce(F.col("id"), F.lit("")).alias("session_id"), e["score"].alias("score"), e["label"].alias("label"), e["reasons"].alias("reasons"), e["metrics"].alias("metrics"),
        e["tools_used"].alias("tools_used"), e["tool_count"].alias("tool_count"),
    )


def _signals(m: Column) -> Column:
    tools = F.size(m["tools_used"]).cast("bigint")
    error, empty = _ratio(m["tool_error_count"], m["tool_results"]), _ratio(m["truly_empty_assistant"], m["assistant_turns"])
    return F.struct(
        tools.alias("tools"), error.alias("error"), empty.alias("empty"),
        clamp(F.log1p(m["total_tokens"]) / F.log1p(F.lit(LENGTH_TOKENS))).alias("length"),
        clamp(F.log1p(m["tool_calls"]) / F.log1p(F.lit(CALLS))).alias("calls"),
        F.when(tools > 0, clamp((tools - 1) / F.lit(TOOLS - 1))).otherwise(0.0).alias("diversity"),
        F.when(m["reads"] & m["writes"], 1.0).otherwise(0.0).alias("edit"),
        _ratio(m["complete_pairs"], m["tool_calls"]).alias("pairing"),
        F.when(m["thinking_tags"] > 0, 1.0).otherwise(0.0).alias("think"),
        F.when(m["user_turns"] > 0, 1.0).otherwise(0.0).alias("user"),
        clamp((error - ERROR_FROM) / ERROR_SPAN).alias("p_error"),
        clamp((empty - EMPTY_FROM) / EMPTY_SPAN).alias("p_empty"),
    )


def _trivial(m: Column, min_turns: int, min_tokens: int) -> Column:
    return (m["total_messages"] < min_turns) | (m["total_tokens"] < min_tokens)


def _raw_score(m: Column, s: Column, min_turns: int, min_tokens: int) -> Column:
    gain = F.lit(0.35) * s["length"] + F.lit(0.20) * s["calls"] + F.lit(0.15) * s["diversity"] + F.lit(0.10) * s["edit"] + F.lit(0.10) * s["pairing"] + F.lit(0.05) * s["think"] + F.lit(0.05) * s["user"]
    raw = gain - F.lit(0.30) * s["p_error"] - F.lit(0.20) * s["p_empty"]
    return clamp(F.when(_trivial(m, min_turns, min_tokens), 0.0).when(m["tool_calls"] == 0, F.least(raw, F.lit(CHATTER_CAP))).otherwise(raw))


def _result(m: Column, s: Column, score: Column, min_turns: int, min_tokens: int) -> Column:
    two = lambda name, c: F.concat(F.lit(name + ":"), F.format_string("%.2f", round_half_even(c, 2)))
    reasons = F.array_compact(
        F.array(
            two("length", s["length"]), two("calls", s["calls"]), two("diversity", s["diversity"]), two("editchain", s["edit"]), two("pairing", s["pairing"]),
            F.when(s["think"] > 0, F.lit("thinking")), F.when(s["user"] == 0, F.lit("no_user_input")),
            F.when(s["p_error"] > 0, two("-error_ratio", s["error"])), F.when(s["p_empty"] > 0, two("-empty_ratio", s["empty"])),
            F.when(_trivial(m, min_turns, min_tokens), F.lit("hard_floor:trivial")).when(m["tool_calls"] == 0, F.lit("cap:no_tool_calls")),
        )
    )
    kept = ("total_messages", "total_tokens", "user_turns", "assistant_turns", "tool_calls", "tool_results", "incomplete_tool_chains", "thinking_tags", "tool_error_count")
    return F.struct(
        round_half_even(score, 3).alias("score"), F.when(score >= GOOD, "good").when(score >= MAYBE, "maybe").otherwise("bad").alias("label"), reasons.alias("reasons"),
        F.struct(*[m[k].alias(k) for k in kept], round_half_even(s["error"], 3).alias("error_ratio"), m["truly_empty_assistant"].alias("truly_empty_assistant")).alias("metrics"),
        m["tools_used"].alias("tools_used"), s["tools"].alias("tool_count"),
    )


def label_histogram(scored: DataFrame) -> DataFrame:
    return scored.groupBy("label").agg(F.count("*").alias("n"))
