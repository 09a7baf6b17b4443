"""Log files and stores on disk as entry tables, and JSON-lines sinks."""

from __future__ import annotations

import sqlite3
import struct
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from sessionloom.functions.text import strip, valid_json

_TREE = "type string, uuid string, parentUuid string, leafUuid string, sessionId string, timestamp string, gitBranch string, cwd string, version string, isCompactSummary boolean, isMeta boolean, message struct<role:string,model:string,content:string>"
_CHAT = "uuid string, type string, subtype string, timestamp string, message struct<parts:string>, toolCallResult struct<callId:string>"


def exists(spark: SparkSession, pattern: str) -> bool:
    """Whether anything matches a path or pattern, in whatever file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    return bool(path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path))


def _raw_lines(spark: SparkSession, paths: list[str], **options) -> DataFrame:
    """(file_path, line_no, line): every line of every file, files split over tasks as they are large.

    line_no grows along a file without being dense: the place of the line's split, then
    its number among the lines its task read.
    """
    if not paths:
        return spark.createDataFrame([], "file_path string, line_no bigint, line string")
    reader = spark.read
    for k, v in options.items():
        reader = reader.option(k, v)
    split = F.floor(F.col("_metadata.file_block_start") / 4096)
    number = split * F.lit(2**33) + F.monotonically_increasing_id().bitwiseAND(2**33 - 1)
    return reader.text(paths).select(F.url_decode("_metadata.file_path").alias("file_path"), number.cast("bigint").alias("line_no"), F.col("value").alias("line"))


def bad_files(raw: DataFrame) -> DataFrame:
    """(file_path, error) of the files that can't be read as UTF-8 text; their sessions are left out, all others stay."""
    return raw.where(~F.is_valid_utf8("line")).select("file_path", F.lit("not UTF-8").alias("error")).distinct()


def lines(spark: SparkSession, paths: list[str], **options) -> DataFrame:
    """(file_path, line_no, line) in the files' order without blank lines; files that aren't UTF-8 are left out."""
    raw = _raw_lines(spark, paths, **options)
    return raw.join(bad_files(raw).select("file_path"), "file_path", "left_anti").withColumn("line", strip(F.col("line"))).where("line <> ''")


def _objects(df: DataFrame) -> DataFrame:
    """Lines that are one JSON object; keys may repeat, the last one holds."""
    return df.where(F.col("line").startswith("{")).where(valid_json(F.col("line")))


def _parsed(df: DataFrame, schema: str, *more) -> DataFrame:
    """Lines that are no JSON object are skipped."""
    return _objects(df).select("file_path", "line_no", F.lit(0).cast("bigint").alias("row_id"), F.from_json("line", schema).alias("j"), *more).select("file_path", "line_no", "row_id", "j.*", *[F.col(c) for c in ("content_kind",) if more])


_TREE_OPTIONS = {"recursiveFileLookup": "true", "pathGlobFilter": "*.jsonl"}


def tree_entries(spark: SparkSession, root: str) -> DataFrame:
    """Entries of every .jsonl file below ``root``; none if it isn't there. content_kind tells arrays from texts."""
    is_array = F.from_json("line", "message struct<content:array<string>>")["message"]["content"].isNotNull()
    return _parsed(lines(spark, [root] if exists(spark, root) else [], **_TREE_OPTIONS), _TREE, F.when(is_array, "array").otherwise("text").alias("content_kind"))


def unread(spark: SparkSession, name: str, root: str) -> DataFrame:
    """(file_path, error) of a source's files that were left out."""
    path, options = (root, _TREE_OPTIONS) if name == "claude" else (f"{root}/*/chats/*.jsonl", {})
    return bad_files(_raw_lines(spark, [path] if name != "opencode" and exists(spark, path) else [], **options))


def chat_entries(spark: SparkSession, root: str) -> DataFrame:
    paths = [p for p in (f"{root}/*/chats/*.jsonl",) if exists(spark, p)]
    return _parsed(lines(spark, paths), _CHAT).withColumn("parts", F.col("message.parts")).withColumn("callId", F.col("toolCallResult.callId")).drop("message", "toolCallResult")


class _Rows(InputPartition):
    def __init__(self, low: int, high: int):
        self.low, self.high = low, high


class _StoreReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        self.schema, self.path, self.table, self.parts = schema, options["path"], options["table"], int(options.get("partitions", 1))

    def _open(self) -> sqlite3.Connection:
        return sqlite3.connect(f"file:{self.path}?mode=ro", uri=True)

    def partitions(self):
        with self._open() as c:
            low, high = c.execute(f'select coalesce(min(rowid), 0), coalesce(max(rowid), -1) from "{self.table}"').fetchone()
        step = max(1, -(-(high - low + 1) // self.parts))
        return [_Rows(a, min(high + 1, a + step)) for a in range(low, high + 1, step)] or [_Rows(0, 0)]

    def read(self, partition):
        names = [f.name for f in self.schema.fields if f.name != "ord"]
        with self._open() as c:
            rows = c.execute(f'select {", ".join(names)}, rowid from "{self.table}" where rowid >= ? and rowid < ?', (partition.low, partition.high))
            timed = names.index("time_created")
            for r in rows:
                yield tuple(None if v is None else v if isinstance(v, str) else str(v) for v in r[:-1]) + (_order_key(r[timed]) + f"{r[-1]:020d}",)


def _order_key(v) -> str:
    """A text that sorts as SQLite sorts the value: nulls, then numbers by size, then texts."""
    if v is None:
        return "0"
    if isinstance(v, (int, float)):
        bits = struct.unpack(">Q", struct.pack(">d", v))[0]
        return "1" + format(bits ^ (0xFFFFFFFFFFFFFFFF if bits >> 63 else 1 << 63), "016x")
    return "2" + str(v) + "\x00"


class StoreSource(DataSource):
    """A table of a SQLite file, split by rowid: format("sqlite_store") with path, table and partitions."""

    @classmethod
    def name(cls) -> str:
        return "sqlite_store"

    def schema(self) -> str:
        return {"session": "id string, directory string, time_created string, time_updated string, ord string", "message": "id string, session_id string, data string, time_created string, ord string", "part": "message_id string, data string, time_created string, ord string"}[self.options["table"]]

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _StoreReader(schema, self.options)


def store_tables(spark: SparkSession, path: str, partitions: int = 8) -> tuple[DataFrame, DataFrame, DataFrame] | None:
    """(session, message, part) of a store file, or of the ``opencode.db`` in a folder; None if there is none."""
    p = Path(path)
    p = p / "opencode.db" if p.is_dir() else p
    if not p.exists():
        return None
    spark.dataSource.register(StoreSource)
    return tuple(spark.read.format("sqlite_store").options(path=str(p), table=t, partitions=str(partitions)).load() for t in ("session", "message", "part"))


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records of a JSON-lines file or folder; blank and malformed lines are skipped, a missing id
    becomes the record's number among the good lines of its file."""
    good = _objects(lines(spark, [path]))
    rows = good.select("file_path", "line_no", F.from_json("line", schema).alias("j")).select("file_path", "line_no", "j.*")
    if "id" not in rows.columns:
        return rows.drop("file_path", "line_no")
    from pyspark.sql import Window

    numbered = rows.withColumn("_n", F.row_number().over(Window.partitionBy("file_path").orderBy("line_no")) - 1)
    return numbered.withColumn("id", F.coalesce("id", F.col("_n").cast("string"))).drop("_n", "file_path", "line_no")


def write_jsonl(df: DataFrame, path: str) -> None:
    """A folder of JSON-lines parts; null fields are left out."""
    df.write.mode("overwrite").option("ignoreNullFields", "true").json(path)


def ensure_suffix(path: str) -> str:
    return path if Path(path).suffix else path + ".jsonl"


def prompt_table(spark: SparkSession, folder: str | None, user_files: dict[str, str] | None = None) -> DataFrame | None:
    """(source, variant, prompt) from ``<folder>/<source>[.<variant>].md``; a user's own file for a source
    replaces all its variants."""
    rows = []
    for f in sorted(Path(folder).glob("*.md")) if folder else []:
        source, _, variant = f.stem.partition(".")
        rows.append((source, variant or None, f.read_text(encoding="utf-8")))
    for source, f in (user_files or {}).items():
        if Path(f).is_file() and (text := Path(f).read_text(encoding="utf-8").strip()):
            rows = [r for r in rows if r[0] != source] + [(source, v, text) for v in (("beast", "codex", "gpt", "gemini", "anthropic", "trinity", "kimi", "default") if source == "opencode" else (None,))]
    return spark.createDataFrame(rows, "source string, variant string, prompt string") if rows else None
