"""Token budget: exact token counts per document, rolled up by source, language and domain.

Oversized texts are cut, only where the tokenizer's pretokens cannot reach across;
the pieces are salted over the workers and their exact counts summed. All other
texts are counted where they are read.
"""

from __future__ import annotations

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionloom.llm import bpe

#: Characters from which a text is cut.
OVERSIZED = 1 << 17
MISSING = "(missing)"

#: Between two characters no pretoken spans: a word's end before white space, a change of class not behind an
#: apostrophe (or behind one that isn't the first mark), and the place before the last of several white spaces.
FREE = regex.compile(r"(?<=\S)(?=\s)|(?<=\p{L})(?=[^\s\p{L}])|(?<=\p{N})(?=[^\s\p{N}])|(?<=[^\s\p{L}\p{N}'])(?=[\p{L}\p{N}])|(?<=[^\s\p{L}\p{N}]')(?=[\p{L}\p{N}])|(?<=\s)(?=\s\S)")


def cuts(text: str, size: int) -> list[int]:
    """Where ``text`` can be cut into pieces of about ``size`` characters so that the pieces' tokens
    are those of the whole. A run without such a place stays whole."""
    out, at = [0], size
    while at < len(text):
        m = FREE.search(text, at)
        if not m or m.start() >= len(text):
            break
        out.append(m.start())
        at = m.start() + size
    return [*out, len(text)]


def label(c: Column) -> Column:
    """A slice label in one spelling; missing and blank ones stay visible."""
    t = F.lower(F.trim(F.regexp_replace(c, r"\s+", " ")))
    return F.when(F.length(t) > 0, t).otherwise(F.lit(MISSING))


def language(c: Column) -> Column:
    """The language part of a tag: ``EN``, ``en-XX`` and ``en_xx`` are ``en``."""
    return F.regexp_replace(label(c), r"^([a-z]{2,3})[-_].*$", "$1")


def count_tokens(rows: DataFrame, keys: list[str], text: str = "text", path: str | None = None, oversized: int = OVERSIZED) -> DataFrame:
    """keys + n_tokens, one row per distinct key.

    Null and empty texts have 0 tokens. Rows that repeat both key and text (the same text logged
    twice) count once; different texts of one key all count. Keys may be null; other columns are
    not read.
    """
    path = path or bpe.default_path()
    # a text is told from others of its key by its hash; names that start so are the function's own
    rows = rows.select(*keys, F.xxhash64(text).alias("_of"), F.col(text).alias("_text"))
    given, keys, text = keys, [*keys, "_of"], "_text"
    spec = ", ".join(f"`{k}` {t}" for k, t in rows.select(*keys).dtypes)
    n_keys = len(keys)

    def small_and_pieces(batches):
        """Counts of the small texts; an oversized one as pieces without a count yet."""
        tool = bpe.load(path)
        for batch in batches:
            texts = batch.column(n_keys)
            for begin, end in bpe.batches_of(texts):
                part = texts.slice(begin, end - begin).to_pylist()
                at, chunk_no, counts, pieces, small = [], [], [], [], []
                for i, t in enumerate(part):
                    if t is not None and len(t) > oversized:
                        places = cuts(t, oversized // 2)
                        for j, (a, b) in enumerate(zip(places, places[1:])):
                            at.append(i), chunk_no.append(j), counts.append(None), pieces.append(t[a:b])
                        part[i] = None
                    else:
                        small.append(i)
                sizes = tool.count(part)
                at += small
                chunk_no += [0] * len(small)
                counts += [int(sizes[i]) for i in small]
                pieces += [None] * len(small)
                rows_ = pa.array([begin + i for i in at], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*[c.take(rows_) for c in batch.columns[:n_keys]], pa.array(chunk_no, pa.int32()), pa.array(counts, pa.int64()), pa.array(pieces, pa.string())],
                    names=[*keys, "chunk_no", "n", "piece"],
                )

    def pieces_only(batches):
        tool = bpe.load(path)
        for batch in batches:
            sizes = tool.count(batch.column(n_keys + 1).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[: n_keys + 1], pa.array(sizes, pa.int64())], names=[*keys, "chunk_no", "n"])

    # read twice, each time for its own part: no piece of a small text is ever shuffled
    length = F.length(text)
    small = rows.where(length.isNull() | (length <= oversized)).select(*keys, text).mapInArrow(small_and_pieces, f"{spec}, chunk_no int, n bigint, piece string").drop("piece")
    large = rows.where(length > oversized).select(*keys, text).mapInArrow(small_and_pieces, f"{spec}, chunk_no int, n bigint, piece string")
    salted = large.repartition(F.xxhash64(*keys, "chunk_no")).select(*keys, "chunk_no", "piece").mapInArrow(pieces_only, f"{spec}, chunk_no int, n bigint")
    chunks = small.unionByName(salted)
    once = chunks.groupBy(*keys, "chunk_no").agg(F.max("n").alias("n"))
    return once.groupBy(*given).agg(F.sum("n").alias("n_tokens"))


def texts(spark, sf: str) -> DataFrame:
    """Every text with its labels: documents, and the contents of conversation records' messages."""
    d = spark.read.parquet(f"{sf}/documents.parquet").select(
        F.lit("documents").alias("origin"), F.col("doc_id").cast("string").alias("key"), F.lit(0).alias("msg_no"),
        label(F.col("source")).alias("source"), language(F.col("lang")).alias("lang"), label(F.col("domain")).alias("domain"), "text",
    )
    r = spark.read.parquet(f"{sf}/conversation_records.parquet").select("id", "source", "metadata.lang", "metadata.domain", F.posexplode_outer("messages").alias("msg_no", "m"))
    r = r.select(
        F.lit("conversation_records").alias("origin"), F.col("id").alias("key"), F.coalesce("msg_no", F.lit(0)).alias("msg_no"),
        label(F.col("source")).alias("source"), language(F.col("lang")).alias("lang"), label(F.col("domain")).alias("domain"), F.col("m.content").alias("text"),
    )
    return d.unionByName(r)


def tokens_by_document(spark, sf: str, path: str | None = None) -> DataFrame:
    """(origin, key, source, lang, domain, n_tokens), one row per document or record."""
    keys = ["origin", "key", "msg_no", "source", "lang", "domain"]
    counted = count_tokens(texts(spark, sf), keys, path=path)
    return counted.groupBy("origin", "key", "source", "lang", "domain").agg(F.sum("n_tokens").alias("n_tokens"))


def budget(counted: DataFrame) -> DataFrame:
    """(level, source, lang, domain, n_docs, n_tokens): each slice, each label alone, and all."""
    sets = counted.groupingSets([("source", "lang", "domain"), ("source",), ("lang",), ("domain",), ()], "source", "lang", "domain")
    out = sets.agg(F.grouping_id().alias("g"), F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
    level = F.when(F.col("g") == 0, "slice").when(F.col("g") == 3, "source").when(F.col("g") == 5, "lang").when(F.col("g") == 6, "domain").otherwise("all")
    return out.select(level.alias("level"), "source", "lang", "domain", "n_docs", "n_tokens")


def p7_budget(spark, sf: str) -> DataFrame:
    return budget(tokens_by_document(spark, sf))


def p7_tokens(spark, sf: str) -> DataFrame:
    return tokens_by_document(spark, sf)
