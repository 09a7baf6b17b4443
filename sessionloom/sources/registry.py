"""Sources by name: each is a function (spark, path) -> canonical conversations."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionloom.operators.stitch import stitch
from sessionloom.schema import CONVERSATION
from sessionloom.session import written
from sessionloom.sources import entries, files

SOURCES: dict[str, Callable[..., DataFrame]] = {}
DEFAULT_FOLDERS = {"claude": "~/.claude/projects", "qwen": "~/.qwen/projects", "opencode": "~/.local/share/opencode"}


def source(name: str):
    def add(f):
        SOURCES[name] = f
        return f

    return add


def get_source(name: str) -> Callable[..., DataFrame]:
    if name not in SOURCES:
        raise ValueError(f"Unknown source {name!r}; known are {', '.join(SOURCES)}")
    return SOURCES[name]


@source("claude")
def claude(spark: SparkSession, path: str, **options) -> DataFrame:
    sessions, links, owners = entries.tree_sessions(files.tree_entries(spark, path), **options)
    return stitch(written(sessions, "sessions"), links, owners)


@source("opencode")
def opencode(spark: SparkSession, path: str, **options) -> DataFrame:
    tables = files.store_tables(spark, path)
    return entries.store_sessions(*tables, **options) if tables else spark.createDataFrame([], CONVERSATION)


@source("qwen")
def qwen(spark: SparkSession, path: str, **options) -> DataFrame:
    return entries.chat_sessions(files.chat_entries(spark, path), **options).drop("file_path")


def folder(name: str, path: str | None = None) -> str:
    return path or os.path.expanduser(DEFAULT_FOLDERS.get(name, "."))


def parse(spark: SparkSession, name: str, path: str | None = None, prompts: DataFrame | None = None, **options) -> DataFrame:
    """One source, or the union of all with ``all``."""
    out = None
    for n in SOURCES if name == "all" else [name]:
        df = get_source(n)(spark, folder(n, path), **options)
        out = df if out is None else out.unionByName(df)
    return entries.with_prompt(out, prompts)


def in_order(conversations: DataFrame) -> DataFrame:
    """The order of the sinks: source by source; sessions of trees by their start, their subagents
    after them; all others by id."""
    rank = F.array_position(F.array(*map(F.lit, SOURCES)), F.col("source"))
    return conversations.orderBy(rank, F.coalesce("metadata.is_subagent", F.lit(False)), F.when(F.col("source") == "claude", F.coalesce("metadata.start_time", F.lit(""))), "id")


def unread(spark: SparkSession, name: str, path: str | None = None) -> DataFrame:
    """(file_path, error) of the files that were left out; every other session is parsed all the same."""
    out = None
    for n in SOURCES if name == "all" else [name]:
        df = files.unread(spark, n, folder(n, path))
        out = df if out is None else out.unionByName(df)
    return out
