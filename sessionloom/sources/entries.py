"""Raw log entries of three layouts to canonical conversations.

Each function takes entry tables (from the file readers in ``files`` or from tables
of the same columns) and gives one row per session. Messages are made as tall rows,
paired by equi-joins and put together once per session.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionloom.functions.plan import fenced
from sessionloom.functions.text import NOT_WS, strip, thinking_first
from sessionloom.operators.toolschema import first_schemas
from sessionloom.schema import CALL, MESSAGE, METADATA, TOOL

_BLOCK = "type string, text string, thinking string, id string, name string, input string, tool_use_id string, content string, is_error string"


def _message(role: Column | str, content: Column, name: Column | None = None, call_id: Column | None = None, is_error: Column | None = None, calls: Column | None = None) -> Column:
    none = F.lit(None)
    return F.struct(
        (F.lit(role) if isinstance(role, str) else role).alias("role"), content.alias("content"), (name if name is not None else none).cast("string").alias("name"),
        (call_id if call_id is not None else none).cast("string").alias("tool_call_id"), (is_error if is_error is not None else none).cast("boolean").alias("is_error"),
        (calls if calls is not None else none).cast(f"array<{CALL}>").alias("tool_calls"),
    )


def _kept(m: str = "msg") -> Column:
    """A message counts if it has text or calls."""
    return (F.coalesce(F.length(f"{m}.content"), F.lit(0)) > 0) | (F.coalesce(F.size(f"{m}.tool_calls"), F.lit(0)) > 0)


def _blocks(content: Column, kind: Column) -> Column:
    """Content as blocks, null where it is plain text.

    ``kind`` says ``array`` or ``text`` where the source knows it (files do). A table of texts
    doesn't: there an array counts as blocks if all its elements are objects with a type.
    """
    items = F.when(content.startswith("["), F.from_json(content, "array<string>"))
    typed = F.forall(items, lambda x: x.startswith("{") & F.get_json_object(x, "$.type").isNotNull())
    items = F.when((kind == "array") | (kind.isNull() & typed), items)
    # a result's content is a text or an array; only the array is taken apart
    answer = lambda x: F.when(x.contains("tool_result"), F.from_json(x, "content array<string>")["content"])
    return F.transform(items, lambda x: F.from_json(x, _BLOCK).withField("items", answer(x)))


def _result_text(block: Column) -> Column:
    each = F.transform(block["items"], lambda x: F.coalesce(F.when(x.startswith("{"), F.get_json_object(x, "$.text")), x))
    return F.coalesce(F.array_join(each, "\n"), block["content"], F.lit(""))


def _sessions(rows: DataFrame, session: str, order: list[str], min_turns: int) -> DataFrame:
    """session + messages in order, of sessions with enough messages."""
    packed = rows.where(_kept()).groupBy(session).agg(F.array_sort(F.collect_list(F.struct(*order, F.col("msg")))).alias("m"))
    # the order's columns are distinct per message, so the sort never compares messages
    return packed.where(F.size("m") >= min_turns).select(session, fenced(F.transform("m", lambda x: x["msg"]).cast(f"array<{MESSAGE}>")).alias("messages"))


def _tools(sessions: DataFrame, calls: DataFrame, session: str, order: list[str]) -> DataFrame:
    tools = first_schemas(calls, [session], order)
    parsed = F.transform("tools_json", lambda t: F.from_json(t, TOOL))
    return sessions.join(tools, session, "left").withColumn("tools", fenced(F.coalesce(parsed, F.array().cast(f"array<{TOOL}>")))).drop("tools_json")


def tree_sessions(entries: DataFrame, include_thinking: bool = True, min_turns: int = 2) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sessions, links, owners) of line-delimited trees (one row per line: file_path, line_no, ...).

    sessions: file_path, id, source, metadata, tools, messages. links: what ties a file to
    its predecessor. owners: which uuids a file has. Metadata comes from the file's first
    entry, its end from the last timestamp; synthetic turns make no messages, yet their
    tool results count. A result stands directly behind its call's message, the last of one id wins.
    """
    e = entries.select(
        "file_path", F.col("line_no").cast("bigint").alias("line_no"), F.coalesce(F.col("row_id"), F.lit(0)).cast("bigint").alias("row_id") if "row_id" in entries.columns else F.lit(0).cast("bigint").alias("row_id"),
        "type", F.when(F.col("uuid") != "", F.col("uuid")).alias("uuid"), F.when(F.col("parentUuid") != "", F.col("parentUuid")).alias("parent"), F.when(F.col("leafUuid") != "", F.col("leafUuid")).alias("leaf"),
        "sessionId", F.col("timestamp").alias("ts"), "gitBranch", "cwd", "version", (F.coalesce(F.col("isCompactSummary"), F.lit(False)) | F.coalesce(F.col("isMeta"), F.lit(False))).alias("synthetic"),
        F.col("message.model").alias("model"), F.col("message.content").alias("content"), (F.col("content_kind") if "content_kind" in entries.columns else F.lit(None).cast("string")).alias("content_kind"),
    )
    at = F.struct("line_no", "row_id")
    sub = F.col("file_path").contains("/subagents/")
    stem = F.regexp_extract("file_path", r"([^/]*?)(?:\.[^./]*)?$", 1)
    facts = e.groupBy("file_path").agg(
        F.min_by(F.struct("sessionId", "gitBranch", "cwd", "version", "ts", "model"), at).alias("h"),
        F.max_by("ts", F.when(F.coalesce(F.length("ts"), F.lit(0)) > 0, at)).alias("end_time"),
        F.min_by("model", F.when((F.col("type") == "assistant") & (F.col("model") != "") & ~F.col("synthetic"), at)).alias("later_model"),
        F.min_by("parent", F.when(F.col("parent").isNotNull(), at)).alias("first_parent"),
        F.min_by("leaf", F.when((F.col("type") == "summary") & F.col("leaf").isNotNull(), at)).alias("summary_leaf"),
    )
    owners = e.where("uuid is not null").select("file_path", "uuid").distinct()
    own = owners.select("file_path", F.col("uuid").alias("first_parent"), F.lit(True).alias("own"))
    links = facts.join(own, ["file_path", "first_parent"], "left").select(
        "file_path", F.when(F.col("own").isNull(), F.col("first_parent")).alias("first_parent"), "summary_leaf", sub.alias("is_subagent"), F.col("h.ts").alias("start_time")
    )
    parsed = e.where("type in ('user', 'assistant')").withColumn("blocks", _blocks(F.col("content"), F.col("content_kind")))
    results = (
        parsed.where("type = 'user'").select("file_path", "line_no", "row_id", F.posexplode("blocks").alias("k", "b")).where("b.type = 'tool_result' and b.tool_use_id <> ''")
        .groupBy("file_path", F.col("b.tool_use_id").alias("call_id")).agg(F.max_by(F.struct(_result_text(F.col("b")).alias("content"), F.col("b.is_error").alias("is_error")), F.struct("line_no", "row_id", "k")).alias("r"))
    )
    real = parsed.where("not synthetic")
    texts = lambda kind, field: F.transform(F.filter("blocks", lambda b: (b["type"] == kind) & b[field].rlike(NOT_WS)), lambda b: b[field])
    user = real.where("type = 'user'").select("file_path", "line_no", "row_id", F.lit(0).alias("k"), _message("user", strip(F.when(F.col("blocks").isNotNull(), F.array_join(texts("text", "text"), "\n")).otherwise(F.coalesce("content", F.lit(""))))).alias("msg"))
    thoughts = F.reverse(F.transform(texts("thinking", "thinking"), lambda t: F.concat(F.lit("<think>"), t, F.lit("</think>")))) if include_thinking else F.array().cast("array<string>")
    said = strip(F.array_join(F.concat(thoughts, texts("text", "text")), "\n"))
    calls = F.transform(
        F.filter("blocks", lambda b: b["type"] == "tool_use"),
        lambda b: F.struct(F.coalesce(b["id"], F.lit("")).alias("id"), F.lit("function").alias("type"), F.struct(F.coalesce(b["name"], F.lit("")).alias("name"), F.coalesce(b["input"], F.lit("{}")).alias("arguments")).alias("function")),
    )
    agent = real.where("type = 'assistant'").withColumn("calls", calls)
    turns = agent.select("file_path", "line_no", "row_id", F.lit(0).alias("k"), _message("assistant", F.coalesce(said, F.lit("")), calls=F.when(F.size("calls") > 0, F.col("calls"))).alias("msg"))
    called = agent.select("file_path", "line_no", "row_id", F.posexplode("calls").alias("k", "c"))
    flag = F.when(F.lower("r.is_error") == "true", True)
    answers = called.withColumn("call_id", F.col("c.id")).join(results, ["file_path", "call_id"]).select("file_path", "line_no", "row_id", (F.col("k") + 1).alias("k"), _message("tool", F.col("r.content"), F.col("c.function.name"), F.col("call_id"), flag).alias("msg"))
    rows = user.unionByName(turns).unionByName(answers)
    order = ["line_no", "row_id", "k"]
    made = _tools(_sessions(rows, "file_path", order, min_turns), called.select("file_path", *order, F.col("c.function.name").alias("name"), F.col("c.function.arguments").alias("arguments")), "file_path", order)
    sid = F.coalesce(F.when(F.col("h.sessionId") != "", F.col("h.sessionId")), stem)
    meta = F.struct(
        F.coalesce(F.when(F.col("h.model") != "", F.col("h.model")), F.col("later_model")).alias("model"), F.col("h.gitBranch").alias("git_branch"), F.col("h.cwd").alias("cwd"), F.col("h.ts").alias("start_time"), F.col("end_time").alias("end_time"),
        F.col("h.version").alias("version"), F.col("h.sessionId").alias("session_id"), F.when(sub, True).alias("is_subagent"), F.lit(None).cast("array<string>").alias("resumed_from"),
    )
    sessions = made.join(facts, "file_path").select("file_path", F.when(sub, F.concat(sid, F.lit("::"), stem)).otherwise(sid).alias("id"), F.lit("claude").alias("source"), meta.cast(METADATA).alias("metadata"), "tools", "messages")
    return sessions, links, owners


_PART = "text string, functionCall struct<id:string,name:string,args:string>, functionResponse struct<name:string,response:struct<output:string,error:string>>"


def chat_sessions(entries: DataFrame, include_thinking: bool = True, min_turns: int = 2) -> DataFrame:
    """Sessions of chat logs (file_path, line_no, uuid, type, subtype, timestamp, parts, callId).

    Rows go by their timestamp as text, missing first, then by line. Of the rows of one
    uuid, missing counting as one, the first user, assistant, tool_result or telemetry row
    blocks all later ones. Calls without an id are named by their place in the message.
    """
    e = entries.select("file_path", F.col("line_no").cast("bigint").alias("line_no"), F.coalesce("uuid", F.lit("")).alias("uuid"), "type", "subtype", F.coalesce("timestamp", F.lit("")).alias("ts"), "parts", F.coalesce("callId", F.lit("")).alias("call_id"), *(["row_id"] if "row_id" in entries.columns else [F.lit(0).cast("bigint").alias("row_id")]))
    marks = F.col("type").isin("user", "assistant", "tool_result") | ((F.col("type") == "system") & (F.col("subtype") == "ui_telemetry"))
    by_uuid = Window.partitionBy("file_path", "uuid").orderBy("ts", "line_no", "row_id").rowsBetween(Window.unboundedPreceding, -1)
    first = e.withColumn("blocked", F.max(F.coalesce(marks, F.lit(False))).over(by_uuid)).where("blocked is null or not blocked")
    at = F.struct("ts", "line_no", "row_id")
    times = first.groupBy("file_path").agg(F.min_by("ts", F.when(F.col("ts") != "", at)).alias("start_time"), F.max_by("ts", F.when(F.col("ts") != "", at)).alias("end_time"))
    p = first.withColumn("p", F.transform(F.from_json("parts", "array<string>"), lambda x: F.from_json(x, _PART)))
    order = ["ts", "line_no", "row_id", "k"]
    said = F.filter("p", lambda x: (F.coalesce(F.length(x["text"]), F.lit(0)) > 0) & ~x["text"].contains("--- Content from referenced files ---"))
    user = p.where("type = 'user'").select("file_path", "ts", "line_no", "row_id", F.lit(0).alias("k"), _message("user", strip(F.array_join(F.transform(said, lambda x: x["text"]), "\n"))).alias("msg"))
    text = F.array_join(F.transform(F.filter("p", lambda x: x["text"].isNotNull()), lambda x: x["text"]), "\n")
    content = thinking_first(text) if include_thinking else strip(F.regexp_replace(text, r"(?s)<think>(.*?)</think>", ""))
    calls = F.transform(
        F.filter("p", lambda x: x["text"].isNull() & x["functionCall"].isNotNull()),
        lambda x, i: F.struct(F.coalesce(x["functionCall"]["id"], F.concat(F.lit("call_"), i.cast("string"))).alias("id"), F.lit("function").alias("type"), F.struct(F.coalesce(x["functionCall"]["name"], F.lit("")).alias("name"), F.coalesce(x["functionCall"]["args"], F.lit("{}")).alias("arguments")).alias("function")),
    )
    agent = p.where("type = 'assistant'").withColumn("calls", calls)
    turns = agent.select("file_path", "ts", "line_no", "row_id", F.lit(0).alias("k"), _message("assistant", F.when(F.length(content) > 0, content), calls=F.when(F.size("calls") > 0, F.col("calls"))).alias("msg"))
    tool = p.where("type = 'tool_result'").select("file_path", "ts", "line_no", "row_id", "call_id", F.posexplode("p").alias("k", "x")).where("x.functionResponse is not null")
    output, error = F.col("x.functionResponse.response.output"), F.col("x.functionResponse.response.error")
    lines = F.array_compact(F.array(F.when(output != "", output), F.when(error != "", F.concat(F.lit("Error: "), error))))
    answers = tool.select("file_path", "ts", "line_no", "row_id", "k", _message("tool", strip(F.array_join(lines, "\n")), F.coalesce("x.functionResponse.name", F.lit("")), F.col("call_id")).alias("msg"))
    rows = user.unionByName(turns).unionByName(answers)
    called = agent.select("file_path", "ts", "line_no", "row_id", F.posexplode("calls").alias("k", "c"))
    made = _tools(_sessions(rows, "file_path", order, min_turns), called.select("file_path", *order, F.col("c.function.name").alias("name"), F.col("c.function.arguments").alias("arguments")), "file_path", order)
    cwd = F.regexp_extract("file_path", r"^(.*?)/?[^/]*/[^/]*$", 1)
    none = F.lit(None).cast("string")
    meta = F.struct(none.alias("model"), none.alias("git_branch"), cwd.alias("cwd"), F.col("start_time"), F.col("end_time"), none.alias("version"), none.alias("session_id"), F.lit(None).cast("boolean").alias("is_subagent"), F.lit(None).cast("array<string>").alias("resumed_from"))
    return made.join(times, "file_path").select("file_path", F.regexp_extract("file_path", r"([^/]*?)(?:\.[^./]*)?$", 1).alias("id"), F.lit("qwen").alias("source"), meta.cast(METADATA).alias("metadata"), "tools", "messages")


def variant(model: Column) -> Column:
    """Which system prompt a model gets; the first tests heed case, the last two don't."""
    m = strip(F.coalesce(model, F.lit("")))
    low = F.lower(m)
    return (
        F.when(m.contains("gpt-4") | m.contains("o1") | m.contains("o3"), "beast").when(m.contains("gpt"), F.when(m.contains("codex"), "codex").otherwise("gpt"))
        .when(m.contains("gemini-"), "gemini").when(m.contains("claude"), "anthropic").when(low.contains("trinity"), "trinity").when(low.contains("kimi"), "kimi").otherwise("default")
    )


_OC_PART = "type string, text string, id string, tool string, state struct<input:string,status:string,output:string>"


def store_sessions(session: DataFrame, message: DataFrame, part: DataFrame, include_thinking: bool = True, min_turns: int = 2) -> DataFrame:
    """Sessions of a message store: session(id, directory, time_created, time_updated),
    message(id, session_id, data, time_created), part(message_id, data, time_created).

    Two equi-joins; order is by ord, the reader's own order of time_created and row number, or
    where there is none by time_created and the row's own text. A call's result stands directly behind the assistant turn. Rows that
    are repeated whole count once.
    """
    tie = lambda df: "ord" if "ord" in df.columns else "data"
    # ord alone decides where it is known: numbers as text would put 10 before 9
    when = lambda df: F.lit("") if "ord" in df.columns else F.col("time_created")
    s = session.select("id", "directory", "time_created", "time_updated").distinct()
    cols = lambda df, *c: [*c, F.col(tie(df)).cast("string").alias("tie")]
    m = message.select(*cols(message, F.col("id").alias("message_id"), "session_id", "data", when(message).alias("time_created"))).distinct()
    p = part.select(*cols(part, "message_id", F.col("data").alias("part"), when(part).alias("part_time"))).withColumnRenamed("tie", "part_tie").distinct()
    m = m.withColumn("role", F.get_json_object("data", "$.role")).withColumn("model", F.coalesce(F.get_json_object("data", "$.model.modelID"), F.when(~F.coalesce(F.get_json_object("data", "$.model").startswith("{"), F.lit(False)), F.get_json_object("data", "$.model"))))
    parts = p.groupBy("message_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("part_time", "part_tie", "part"))), lambda x: F.from_json(x["part"], _OC_PART)).alias("p"))
    full = m.join(parts, "message_id", "left")
    texts = F.transform(F.filter("p", lambda x: (x["type"] == "text") & x["text"].rlike(NOT_WS)), lambda x: x["text"])
    thoughts = F.reverse(F.transform(F.filter("p", lambda x: (x["type"] == "reasoning") & x["text"].rlike(NOT_WS)), lambda x: F.concat(F.lit("<think>"), x["text"], F.lit("</think>"))))
    both = F.concat(thoughts, texts) if include_thinking else texts
    content = strip(F.array_join(F.coalesce(both, F.array().cast("array<string>")), "\n"))
    tools = F.transform(
        F.filter("p", lambda x: x["type"] == "tool"),
        lambda x, i: F.struct(F.coalesce(x["id"], F.concat(F.lit("call_"), i.cast("string"))).alias("id"), F.coalesce(x["tool"], F.lit("")).alias("name"), F.coalesce(x["state"]["input"], F.lit("{}")).alias("arguments"), F.coalesce(x["state"]["output"], F.lit("")).alias("output"), x["state"]["status"].alias("status")),
    )
    full = full.withColumn("content", content).withColumn("t", F.when(F.col("role") == "assistant", F.coalesce(tools, F.array().cast("array<struct<id:string,name:string,arguments:string,output:string,status:string>>"))))
    calls = F.transform("t", lambda x: F.struct(x["id"].alias("id"), F.lit("function").alias("type"), F.struct(x["name"].alias("name"), x["arguments"].alias("arguments")).alias("function")))
    order = ["time_created", "tie", "message_id", "k"]
    key = ["session_id", "time_created", "tie", "message_id"]
    turns = full.where("role in ('user', 'assistant')").select(*key, F.lit(0).alias("k"), _message(F.col("role"), F.when((F.col("role") == "user") | (F.length("content") > 0), F.col("content")), calls=F.when((F.col("role") == "assistant") & (F.size("t") > 0), calls)).alias("msg"))
    called = full.where("role = 'assistant'").select(*key, F.posexplode("t").alias("k", "c"))
    answers = called.select(*key, (F.col("k") + 1).alias("k"), _message("tool", F.col("c.output"), F.col("c.name"), F.col("c.id"), F.when(F.col("c.status") == "error", True)).alias("msg"))
    made = _tools(_sessions(turns.unionByName(answers), "session_id", order, min_turns), called.select(*key, "k", F.col("c.name").alias("name"), F.col("c.arguments").alias("arguments")), "session_id", order)
    models = m.groupBy("session_id").agg(F.min_by("model", F.when(F.col("model") != "", F.struct("time_created", "tie", "message_id"))).alias("model"))
    none = F.lit(None).cast("string")
    meta = F.struct(F.col("model"), none.alias("git_branch"), F.col("directory").alias("cwd"), F.col("s_created").cast("string").alias("start_time"), F.col("time_updated").cast("string").alias("end_time"), none.alias("version"), none.alias("session_id"), F.lit(None).cast("boolean").alias("is_subagent"), F.lit(None).cast("array<string>").alias("resumed_from"))
    s = s.withColumnRenamed("id", "session_id").withColumnRenamed("time_created", "s_created")
    return made.join(s, "session_id").join(models, "session_id", "left").select(F.col("session_id").alias("id"), F.lit("opencode").alias("source"), meta.cast(METADATA).alias("metadata"), "tools", "messages")


def with_prompt(conversations: DataFrame, prompts: DataFrame | None) -> DataFrame:
    """Puts each source's system prompt first: prompts has (source, variant, prompt), variant null
    for any model. The table is small by its nature; the engine decides how to join it."""
    if prompts is None:
        return conversations
    c = conversations.withColumn("_variant", F.when(F.col("source") == "opencode", variant(F.col("metadata.model"))).otherwise(F.lit("")))
    p = prompts.where(F.length(strip(F.col("prompt"))) > 0).select("source", F.coalesce("variant", F.lit("")).alias("_variant"), strip(F.col("prompt")).alias("_prompt"))
    first = F.array(_message("system", F.col("_prompt"))).cast(f"array<{MESSAGE}>")
    return c.join(p, ["source", "_variant"], "left").withColumn("messages", F.when(F.col("_prompt").isNull(), F.col("messages")).otherwise(F.concat(first, F.col("messages")))).select(*conversations.columns)
