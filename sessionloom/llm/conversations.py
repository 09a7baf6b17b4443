"""Chat rows as an event log, folded into ordered and validated conversations.

Each row is an event of the message its uuid names: its first event creates the message
and gives it its place, one that says the same again is a retry, one that says something
else an edit, and an event marked as one takes the message back until a later one makes it
anew. What the last version says is the turn's content. Blank and system rows are no
events. Messages are ordered by instant; order, adjacency and numbering are computed in
range-partitioned blocks with a small carry between blocks, so that a chat holding a third
of all rows is spread over as many tasks as its size needs. All of it but the content runs
on narrow rows; contents are joined to the kept turns at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionloom.functions.plan import fenced, let
from sessionloom.functions.text import NOT_WS
from sessionloom.operators.instants import normalise_instants
from sessionloom.session import written

NO_PATH = "\u0001none"
#: Stands for a missing instant where a place is compared; later than any instant.
_LATE = 2**62
_PART = "text string, functionCall string, functionResponse string"


def read_parts(parts: Column) -> Column:
    """struct<valid, full, calls>. valid: null or JSON. full: holds a call, a response or text that
    isn't blank (unreadable parts count as full). calls: the ids of the calls, null for none.

    The text is read inside a wrapping object: what follows its first value, and what would
    add keys, makes the whole invalid.
    """
    strict = {"allowSingleQuotes": "false"}
    wrapped = F.from_json(F.concat(F.lit('{"v":'), parts, F.lit(',"end":1}')), "map<string,string>", strict)
    none = F.array().cast("array<string>")

    def told(m: Column) -> Column:
        valid = F.coalesce((F.size(m) == 2) & (F.try_element_at(m, F.lit("end")) == "1"), F.lit(False))
        value = F.try_element_at(m, F.lit("v"))
        items = F.coalesce(F.when(value.startswith("["), F.from_json(value, "array<string>", strict)), F.array(value))
        # an element that is no object is a text
        each = F.transform(items, lambda x: F.when(x.startswith("{"), F.from_json(x, _PART, strict)).otherwise(F.struct(x.alias("text"), F.lit(None).cast("string").alias("functionCall"), F.lit(None).cast("string").alias("functionResponse"))))

        def read(e: Column) -> Column:
            full = F.exists(e, lambda x: x["functionCall"].isNotNull() | x["functionResponse"].isNotNull() | F.coalesce(x["text"].rlike(NOT_WS), F.lit(False)))
            calls = F.transform(F.filter(e, lambda x: x["functionCall"].isNotNull()), lambda x: F.get_json_object(x["functionCall"], "$.id"))
            return F.struct(F.lit(True).alias("valid"), F.coalesce(full, F.lit(False)).alias("full"), F.coalesce(calls, none).alias("calls"))

        broken = F.struct(F.lit(False).alias("valid"), F.lit(True).alias("full"), none.alias("calls"))
        return F.when(valid, let(each, read)).otherwise(broken)

    empty = F.struct(F.lit(True).alias("valid"), F.lit(False).alias("full"), none.alias("calls"))
    return F.when(parts.isNull(), empty).otherwise(let(wrapped, told))


def events(rows: DataFrame, tz: str = "tz_name", deletes: str | None = None) -> DataFrame:
    """Rows (file_path, line_no, row_id, uuid, type, timestamp, parts, callId and a zone) as events.
    ``deletes`` is a SQL condition over the rows' columns that marks events which take a message back."""
    gone = F.coalesce(F.expr(deletes), F.lit(False)) if deletes else F.lit(False)
    slim = rows.select(F.coalesce("file_path", F.lit(NO_PATH)).alias("file_path"), "line_no", "row_id", "uuid", "type", "parts", "callId", "timestamp", tz, gone.alias("gone"))
    kind = F.lower(F.regexp_replace("type", r"^\s+|\s+$", ""))
    slim = slim.withColumn("kind", kind).where("kind is null or kind <> 'system'")
    read = slim.select("file_path", "line_no", "row_id", "uuid", "kind", "callId", "timestamp", tz, "gone", fenced(read_parts(F.col("parts"))).alias("p"))
    return normalise_instants(read, "timestamp", tz)


def fold(ev: DataFrame) -> DataFrame:
    """One row per uuid and chat: place of its first version, kind, callId, calls and row of its last one,
    the number of versions, and whether all its rows could be read. ``alive`` is false where no
    version is left.

    Versions go by instant (one without an instant is older than all others), then by line_no and
    row_id. A row without a uuid is a message of its own. Partial aggregates keep a chat or
    a uuid of any size to one row per map task.
    """
    key = F.coalesce("uuid", F.concat(F.lit("\u0001row "), F.col("row_id").cast("string")))
    made = F.col("p.full") & ~F.col("gone")
    place = F.struct(F.coalesce("utc_us", F.lit(_LATE)).alias("us"), "line_no", "row_id")
    version = F.struct(F.coalesce("utc_us", F.lit(-_LATE)).alias("us"), "line_no", "row_id")
    folded = ev.groupBy("file_path", key.alias("key")).agg(
        F.min(F.when(made, place)).alias("at"),
        F.max(F.when(made, F.struct(version.alias("version"), "uuid", "kind", "callId", F.col("p.calls").alias("calls")))).alias("m"),
        F.max(F.when(F.col("gone"), version)).alias("gone_at"),
        F.count(F.when(made, 1)).alias("versions"),
        F.bool_and("p.valid").alias("readable"),
    )
    alive = F.col("m").isNotNull() & F.coalesce(F.col("gone_at") < F.col("m.version"), F.lit(True))
    return folded.select(
        "file_path", "m.uuid", "m.kind", "m.callId", "m.calls", F.when(F.col("at.us") < _LATE, F.col("at.us")).alias("us"), "at.line_no", "at.row_id",
        F.col("m.version.row_id").alias("last_row"), "versions", "readable", alive.alias("alive"),
    )


def _placed(ms: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Messages with their sort key, and the calls by chat and id: a tool_result without an
    instant takes the place directly behind the message that issued its callId."""
    calls = ms.where("kind = 'assistant'").select("file_path", F.posexplode("calls").alias("nth", "callId"), F.struct("us", "line_no", "row_id").alias("by"))
    first = calls.where("callId is not null").groupBy("file_path", "callId").agg(F.min(F.struct("by", "nth")).alias("c")).select("file_path", "callId", "c.by", "c.nth")
    own = F.struct("us", "line_no", "row_id")
    # only answers that name a call are joined; all others would meet on one null key
    asks = F.coalesce((F.col("kind") == "tool_result") & F.col("callId").isNotNull(), F.lit(False))
    joined = ms.where(asks).join(first, ["file_path", "callId"], "left")
    behind = F.col("us").isNull() & F.col("by").isNotNull()
    pick = lambda a, b: F.when(behind, a).otherwise(b)
    place = F.struct(pick(F.col("by.us"), F.col("us")).alias("us"), pick(F.col("by.line_no"), F.col("line_no")).alias("line"), pick(F.col("by.row_id"), F.col("row_id")).alias("row"), pick(F.col("nth") + 1, F.lit(0)).alias("nth"), "line_no", "row_id")
    answers = joined.select("file_path", "uuid", "kind", "callId", "last_row", "versions", place.alias("place"), (F.coalesce(F.col("by") < own, F.lit(False)) | behind).alias("answers"))
    plain = F.struct("us", F.col("line_no").alias("line"), F.col("row_id").alias("row"), F.lit(0).alias("nth"), "line_no", "row_id")
    rest = ms.where(~asks).select("file_path", "uuid", "kind", "callId", "last_row", "versions", plain.alias("place"), F.lit(False).alias("answers"))
    return answers.unionByName(rest), calls


def turns(rows: DataFrame, tz: str = "tz_name", deletes: str | None = None) -> DataFrame:
    """(file_path, turn_no, uuid, kind, row_id, versions): the turns of the kept chats in order;
    row_id names the row whose content holds.

    A chat is dropped when it is empty, doesn't begin with the user and end with the
    assistant, leaves a user message without a reply directly behind it, has an
    unanswered call or an answer without an earlier call, or has unreadable parts. A
    call without an id can't be answered. Ties in time go by line_no, then row_id (which must
    be unique). Rows without a uuid are messages of their own. Null file_path is one chat. An
    empty table gives no rows; extra columns are ignored.
    """
    all_ms = written(fold(events(rows, tz, deletes)), "messages")
    broken = all_ms.where("not readable").select("file_path").distinct()
    placed, calls = _placed(all_ms.where("alive"))
    sorted_rows = written(placed.repartitionByRange("file_path", "place").sortWithinPartitions("file_path", "place").withColumn("block", F.spark_partition_id()), "placed")
    # answers and calls, by chat and id: small groups whatever the size of the chat
    asked = calls.select("file_path", "callId", F.lit(1).alias("asked"), F.lit(None).cast("boolean").alias("answers"))
    told = sorted_rows.where("kind = 'tool_result'").select("file_path", "callId", F.lit(0).alias("asked"), "answers")
    pairs = asked.unionByName(told).groupBy("file_path", "callId").agg(F.max("asked").alias("asked"), F.bool_and("answers").alias("answers"))
    unpaired = pairs.where("asked = 0 or answers is null or not answers or callId is null").select("file_path").distinct()
    inside = Window.partitionBy("block", "file_path").orderBy("place")
    numbered = sorted_rows.withColumn("n", F.row_number().over(inside)).withColumn("next", F.lead(F.coalesce("kind", F.lit(""))).over(inside))
    odd = F.col("kind").isNull() | ~F.col("kind").isin("user", "assistant", "tool_result")
    alone = (F.col("kind") == "user") & F.col("next").isNotNull() & (F.col("next") != "assistant")
    edges = numbered.groupBy("file_path", "block").agg(
        F.count("*").alias("size"), F.min_by("kind", "n").alias("first"), F.max_by("kind", "n").alias("last"), F.max(F.coalesce(odd | alone, F.lit(True))).alias("bad")
    )
    edges = written(edges, "edges")
    along = Window.partitionBy("file_path").orderBy("block")
    edges = edges.select("file_path", "block", "first", "last", "bad", F.lead("first").over(along).alias("after"), F.coalesce(F.sum("size").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"))
    cut = F.coalesce((F.col("last") == "user") & (F.col("after") != "assistant"), F.lit(False))
    chats = edges.groupBy("file_path").agg(F.min_by("first", "block").alias("head"), F.max_by("last", "block").alias("tail"), F.max(F.col("bad") | cut).alias("bad"))
    keep = chats.where("head = 'user' and tail = 'assistant' and not bad").select("file_path")
    for lost in (broken, unpaired):
        keep = keep.join(lost, "file_path", "left_anti")
    kept = edges.select("file_path", "block", "offset").join(keep, "file_path", "left_semi")
    out = numbered.join(kept, ["file_path", "block"])
    path = F.when(F.col("file_path") != NO_PATH, F.col("file_path"))
    return out.select(path.alias("file_path"), (F.col("offset") + F.col("n") - 1).cast("int").alias("turn_no"), "uuid", "kind", F.col("last_row").alias("row_id"), "versions")


def conversations(rows: DataFrame, tz: str = "tz_name", deletes: str | None = None) -> DataFrame:
    """(file_path, turn_no, uuid, role, call_id, parts, versions): :func:`turns` with the speaker's
    role and the parts of each message's last version."""
    said = rows.select("row_id", "parts", F.col("callId").alias("call_id"))
    role = F.when(F.col("kind") == "tool_result", "tool").otherwise(F.col("kind"))
    return turns(rows, tz, deletes).join(said, "row_id").select("file_path", "turn_no", "uuid", role.alias("role"), "call_id", "parts", "versions")


def _chat_rows(spark, sf: str) -> DataFrame:
    ws = spark.read.parquet(f"{sf}/workspaces.parquet").select("project", "tz_name")
    return spark.read.parquet(f"{sf}/qwen_entries.parquet").join(ws, "project", "left")


def p1_found(spark, sf: str) -> DataFrame:
    return turns(_chat_rows(spark, sf)).select("file_path", "turn_no", "uuid")


def p1_turns(spark, sf: str) -> DataFrame:
    """The conversations with their contents."""
    return conversations(_chat_rows(spark, sf))
