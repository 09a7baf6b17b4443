"""The core's queries by name: each takes (spark, folder of the tables) and reads whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionloom.functions.text import thinking_count, thinking_first, token_estimate
from sessionloom.operators import clean as cleaning
from sessionloom.operators import drift, hierarchy, instants
from sessionloom.operators import format as formatting
from sessionloom.operators import redact as redaction
from sessionloom.operators import score as scoring
from sessionloom.operators import stitch as stitching
from sessionloom.plans.pipeline import stages
from sessionloom.session import written
from sessionloom.sources import entries


def _table(spark, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _records(spark, sf: str) -> DataFrame:
    return _table(spark, sf, "conversation_records").drop("score", "label")


def _messages(spark, sf: str) -> DataFrame:
    return _records(spark, sf).select("id", F.posexplode("messages").alias("pos", "m"))


def conv_token_counts(spark, sf):
    m = _messages(spark, sf).where("m.role in ('user', 'assistant', 'tool')")
    return m.groupBy("id").agg(F.sum(token_estimate(F.col("m.content"))).alias("n_tokens"))


def conv_metrics(spark, sf):
    return scoring.evaluate(_records(spark, sf)).select("id", "metrics.*", "tool_count")


def conv_score(spark, sf):
    return scoring.evaluate(_records(spark, sf)).select("id", "score", "label", F.array_join("reasons", ";").alias("reasons"))


def conv_label_hist(spark, sf):
    return scoring.label_histogram(scoring.evaluate(_records(spark, sf)))


def conv_filter(spark, sf):
    return formatting.keep_scored(scoring.evaluate(_records(spark, sf)), 0.5).select("id", "score")


def conv_tools_used(spark, sf):
    return scoring.evaluate(_records(spark, sf)).select("id", F.array_join("tools_used", ",").alias("tools_used"))


def conv_tool_pairs(spark, sf):
    return scoring.metrics(_records(spark, sf)).select("id", F.col("m.complete_pairs").alias("complete_pairs"), F.col("m.incomplete_tool_chains").alias("incomplete_calls"))


def failed_commands(spark, sf):
    return _messages(spark, sf).where("m.role = 'tool'").select("id", F.col("pos").cast("bigint").alias("pos"), cleaning.failed_command(F.col("m.content")).alias("failed"))


def clean_conversations(spark, sf):
    c = cleaning.clean(_records(spark, sf))
    roles = F.array_join(F.transform("messages", lambda m: F.substring(m["role"], 1, 1)), "")
    calls = F.aggregate("messages", F.lit(0).cast("bigint"), lambda a, m: a + F.greatest(F.coalesce(F.size(m["tool_calls"]), F.lit(0)), F.lit(0)))
    return c.select("id", F.coalesce("_cleaned_stats.removed_tool_results", F.lit(0)).cast("bigint").alias("removed"), roles.alias("roles"), calls.alias("n_calls"))


def clean_keep_orphans(spark, sf):
    c = cleaning.clean(_records(spark, sf), remove_orphaned=False)
    return c.select("id", F.size("messages").cast("bigint").alias("n_messages"))


def thinking(spark, sf):
    m = _messages(spark, sf).where("m.role = 'assistant' and m.content like '%<think>%'")
    return m.select("id", F.col("pos").cast("bigint").alias("pos"), thinking_count(F.col("m.content")).cast("bigint").alias("n"), F.md5(thinking_first(F.col("m.content"))).alias("text_md5"))


def user_hashes(spark, sf):
    return _table(spark, sf, "name_list").select("name", redaction.user_hash(F.col("name")).alias("user"))


def prompt_variants(spark, sf):
    m = _table(spark, sf, "opencode_message").select(F.get_json_object("data", "$.model.modelID").alias("a"), F.get_json_object("data", "$.model").alias("b"))
    m = m.select(F.coalesce("a", F.when(~F.col("b").startswith("{"), F.col("b"))).alias("model"))
    return m.groupBy("model", entries.variant(F.col("model")).alias("variant")).agg(F.count("*").alias("n"))


def _session_rows(df: DataFrame) -> DataFrame:
    count = lambda role: F.size(F.filter("messages", lambda m: m["role"] == role)).cast("bigint")
    text = F.md5(F.array_join(F.transform("messages", lambda m: F.concat_ws("|", m["role"], F.coalesce(m["content"], F.lit("")), F.coalesce(m["tool_call_id"], F.lit("")))), "\n"))
    return df.select("id", count("user").alias("users"), count("assistant").alias("assistants"), count("tool").alias("tools"), F.col("metadata.start_time").alias("start_time"), F.col("metadata.end_time").alias("end_time"), text.alias("messages_md5"))


def parse_trees(spark, sf):
    sessions, _, _ = entries.tree_sessions(_table(spark, sf, "claude_entries"))
    return _session_rows(sessions)


def parse_chats(spark, sf):
    return _session_rows(entries.chat_sessions(_table(spark, sf, "qwen_entries")))


def parse_stores(spark, sf):
    return _session_rows(entries.store_sessions(*(_table(spark, sf, f"opencode_{t}") for t in ("session", "message", "part"))))


def stitched_sessions(spark, sf):
    sessions, links, owners = entries.tree_sessions(_table(spark, sf, "claude_entries"))
    out = stitching.stitch(written(sessions, "sessions"), links, owners)
    return out.select("id", F.coalesce(F.size("metadata.resumed_from"), F.lit(0)).cast("bigint").alias("resumed"), F.size("messages").cast("bigint").alias("n_messages"))


def session_chains(spark, sf):
    _, links, owners = entries.tree_sessions(_table(spark, sf, "claude_entries"))
    return stitching.chains(links, owners).select("file_path", "root", "place")


def parse_all(spark, sf):
    """The union of all sources, through the whole pipeline."""
    sessions, links, owners = entries.tree_sessions(_table(spark, sf, "claude_entries"))
    out = stitching.stitch(written(sessions, "sessions"), links, owners)
    out = out.unionByName(entries.store_sessions(*(_table(spark, sf, f"opencode_{t}") for t in ("session", "message", "part"))))
    out = out.unionByName(entries.chat_sessions(_table(spark, sf, "qwen_entries")).drop("file_path"))
    # parsed once: the stages after it are narrow and read it from shared storage
    return stages(written(out, "parsed"), min_score=0.5)["final"].select("id", "source", "score", "label", "messages")


def first_tool_schemas(spark, sf):
    sessions = entries.chat_sessions(_table(spark, sf, "qwen_entries"))
    row = lambda t, i: F.struct(i.cast("bigint").alias("pos"), t["function"]["name"].alias("name"), F.array_join(t["function"]["parameters"]["required"], ",").alias("required"))
    return sessions.select("id", F.inline(F.transform("tools", row)))


def first_versions(spark, sf):
    e = _table(spark, sf, "qwen_entries").select("file_path", "uuid", "row_id", "type")
    return stitching.first_by_key(e, ["file_path", "uuid"], ["row_id"])


def arrow_safe_records(spark, sf):
    return formatting.format_for_training(_records(spark, sf)).select("id", F.size("messages").cast("bigint").alias("n"), F.array_join("messages", "\n").alias("json"))


def redacted_records(spark, sf):
    done = redaction.redact(_records(spark, sf), redaction.Anonymizer(home="", user=""))
    return done.select("id", "n_redacted", F.size("messages").cast("bigint").alias("n_messages"))


def anonymised_paths(spark, sf):
    a = redaction.Anonymizer(home="/srv/ws", user="checkout", extra_usernames=["build"])
    return _table(spark, sf, "workspaces").select("project", a.column(F.col("root_path")).alias("path"))


QUERIES = {
    f.__name__: f
    for f in (
        conv_score, conv_token_counts, conv_metrics, conv_label_hist, conv_filter, conv_tools_used, conv_tool_pairs, failed_commands, clean_conversations,
        clean_keep_orphans, thinking, user_hashes, prompt_variants, parse_trees, parse_chats, parse_stores, session_chains, stitched_sessions, parse_all,
        first_tool_schemas, first_versions, arrow_safe_records, redacted_records, anonymised_paths,
    )
} | {
    "p3_found": instants.p3_found,
    "p5_found": hierarchy.p5_found,
    "p5_contracted": hierarchy.p5_contracted,
    "p5_paths": hierarchy.p5_paths,
    "p5_descendants": hierarchy.p5_descendants,
    "p6_found": drift.p6_found,
    "p6_steps": drift.p6_steps,
    "p6_table": drift.p6_table,
}
