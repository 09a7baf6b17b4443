"""Sessions that continue one another across files, merged into one conversation.

Which file follows which is settled on a narrow link table by pointer doubling
(log2 of the longest chain in rounds); messages are shuffled once, at the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionloom.session import drop_written, written


def chains(links: DataFrame, owners: DataFrame) -> DataFrame:
    """(file_path, root, place): each main file's chain and its place in it.

    A file follows the owner (of several, the last by path) of the uuid its first parented
    entry names, or else of its summary's leaf; a first parent that nobody owns rules the
    leaf out. Of several followers of one file the first by path is linked, the others begin
    chains. A file never follows itself; a pure cycle has no beginning and vanishes.
    """
    main = links.where("not is_subagent")
    owner = owners.join(main.select("file_path"), "file_path", "left_semi").groupBy(F.col("uuid").alias("anchor")).agg(F.max("file_path").alias("prev"))
    edge = main.select("file_path", F.coalesce("first_parent", "summary_leaf").alias("anchor")).where("anchor is not null").join(owner, "anchor").where("prev <> file_path")
    edge = edge.groupBy("prev").agg(F.min("file_path").alias("file_path"))
    state = main.select("file_path").join(edge, "file_path", "left").select("file_path", F.coalesce("prev", "file_path").alias("root"), F.when(F.col("prev").isNotNull(), 1).otherwise(0).cast("bigint").alias("place"), F.col("prev").isNull().alias("done"))
    state = written(state, "chains")
    # a chain is at most as long as the table; what is longer runs in a cycle
    limit = state.count()
    while not state.where("not done").isEmpty():
        up = state.select(F.col("file_path").alias("root"), F.col("root").alias("up"), F.col("place").alias("more"), F.col("done").alias("up_done"))
        step = state.where("not done").join(up, "root").select("file_path", F.col("up").alias("root"), (F.col("place") + F.col("more")).alias("place"), F.col("up_done").alias("done"))
        before, state = state, written(state.where("done").unionByName(step.where(F.col("done") | (F.col("place") <= limit))), "chains")
        drop_written(before)
    return state.select("file_path", "root", "place")


def stitch(sessions: DataFrame, links: DataFrame, owners: DataFrame) -> DataFrame:
    """Merged conversations (of sessions with file_path, id, source, metadata, tools, messages).

    Links count only between files that made a session. The chain's first session gives id
    and metadata, the last one the end; tools keep the first place and the last description of
    each name. Subagent sessions stay as they are.
    """
    made = sessions.select("file_path")
    place = chains(links.join(made, "file_path", "left_semi"), owners.join(made, "file_path", "left_semi"))
    parts = sessions.join(place, "file_path")
    packed = parts.groupBy("root").agg(F.array_sort(F.collect_list(F.struct("place", "file_path"))).alias("_order"), F.map_from_entries(F.collect_list(F.struct("file_path", F.struct("id", "source", "metadata", "tools", "messages").alias("s")))).alias("_s"))
    at = F.transform("_order", lambda o: F.element_at("_s", o["file_path"]))
    p = packed.withColumn("c", at)
    head, last = F.element_at("c", 1), F.element_at("c", -1)
    ids = F.transform(F.slice("c", 2, F.size("c")), lambda s: s["id"])
    meta = head["metadata"].withField("resumed_from", F.when(F.size("c") > 1, ids)).withField("end_time", last["metadata"]["end_time"])
    tools = F.flatten(F.transform("c", lambda s: s["tools"]))
    names = F.array_distinct(F.transform(tools, lambda t: t["function"]["name"]))
    merged = F.transform(names, lambda n: F.element_at(F.filter(tools, lambda t: t["function"]["name"].eqNullSafe(n)), -1))
    main = p.select(head["id"].alias("id"), head["source"].alias("source"), meta.alias("metadata"), F.when(F.size("c") > 1, merged).otherwise(tools).alias("tools"), F.flatten(F.transform("c", lambda s: s["messages"])).alias("messages"))
    subs = sessions.join(links.where("is_subagent").select("file_path"), "file_path", "left_semi").select("id", "source", "metadata", "tools", "messages")
    return main.unionByName(subs)


def first_by_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
