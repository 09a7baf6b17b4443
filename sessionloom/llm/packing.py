"""Items of varying length into containers of one capacity, with little space unused.

Hierarchical residual packing. Every partition packs its items best-fit,
largest first, and gives out the containers that are nearly full. The underfull
ones become items of the next round, in fewer groups; rounds end when one group is
left or a round no longer joins anything. A group has a bounded number of items.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionloom.llm import bpe
from sessionloom.session import written

CAPACITY = 4096
#: Filling from which a container is given out; most containers of one group.
FULL, GROUP = 0.995, 100_000

_PARTS = "array<struct<doc_id:bigint,piece_no:int,start_token:bigint,n_tokens:int>>"
_PART_TYPE = pa.list_(pa.struct([("doc_id", pa.int64()), ("piece_no", pa.int32()), ("start_token", pa.int64()), ("n_tokens", pa.int32())]))
_BIN = f"bin string, size int, parts {_PARTS}"


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing: the containers, as lists of item numbers. Ties go to the earlier item
    and the earliest opened container."""
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    bins: list[list[int]] = []
    left: dict[int, list[int]] = {}
    mask = 0  # bit r is set where a container has r left
    for i in order:
        s = sizes[i]
        fit = mask >> s << s
        if fit:
            r = (fit & -fit).bit_length() - 1
            at = left[r].pop()
            if not left[r]:
                mask ^= 1 << r
        else:
            r, at = capacity, len(bins)
            bins.append([])
        bins[at].append(i)
        r -= s
        left.setdefault(r, []).append(at)
        mask |= 1 << r
    return bins


def _batch(bins: list[tuple[str, int, list[dict]]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([b for b, _, _ in bins], pa.string()), pa.array([s for _, s, _ in bins], pa.int32()), pa.array([p for _, _, p in bins], _PART_TYPE)], names=["bin", "size", "parts"])


def _joined(items: list[tuple[str, int, list[dict]]], capacity: int) -> list[tuple[str, int, list[dict]]]:
    """A container bears the name of its first item, so names stay unique through all rounds."""
    out = []
    for members in best_fit([s for _, s, _ in items], capacity):
        first = items[members[0]][0]
        out.append((first, sum(items[i][1] for i in members), [p for i in members for p in items[i][2]]))
    return out


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, path: str | None = None, group: int = GROUP) -> DataFrame:
    """(container_id, doc_id, piece_no, start_token, n_tokens).

    Only a document that alone exceeds the capacity is split, into full pieces and a
    rest. Null and empty texts have 0 tokens and still get a container. Repeated rows
    are packed each. An empty table gives no rows. container_id is the ``doc_id:piece``
    of the container's first part.
    """
    path = path or bpe.default_path()

    def first_round(batches):
        tool = bpe.load(path)
        items: list[tuple[str, int, list[dict]]] = []
        for batch in batches:
            ids = batch.column(0).to_pylist()
            texts = batch.column(1)
            for begin, end in bpe.batches_of(texts):
                sizes = tool.count(texts.slice(begin, end - begin).to_pylist())
                for doc, n in zip(ids[begin:end], map(int, sizes)):
                    for piece, start in enumerate(range(0, max(n, 1), capacity)):
                        size = min(capacity, n - start)
                        items.append((f"{doc}:{piece}", size, [{"doc_id": doc, "piece_no": piece, "start_token": start, "n_tokens": size}]))
            if len(items) >= group:
                yield _batch(_joined(items, capacity))
                items = []
        if items:
            yield _batch(_joined(items, capacity))

    def next_round(table: pa.Table) -> pa.Table:
        items = sorted(zip(table.column("bin").to_pylist(), table.column("size").to_pylist(), table.column("parts").to_pylist()), key=lambda x: x[0])
        return pa.Table.from_batches([_batch(_joined(items, capacity))])

    full = int(capacity * FULL)
    bins = written(docs.select(F.col(key).cast("bigint").alias("doc_id"), text).mapInArrow(first_round, _BIN), "bins")
    given, turn = [bins.where(F.col("size") >= full)], 0
    rest = bins.where(F.col("size") < full)
    n = rest.count()
    while n > 1:
        groups = -(-n // group)
        mixed = rest.withColumn("_group", F.pmod(F.xxhash64("bin", F.lit(turn)), F.lit(groups)))
        bins = written(mixed.groupBy("_group").applyInArrow(next_round, _BIN), "bins")
        done, rest = bins.where(F.col("size") >= full), bins.where(F.col("size") < full)
        given.append(done)
        turn, before, n = turn + 1, n, rest.count()
        if groups == 1 or done.count() + n == before:
            break
    out = rest
    for g in given:
        out = out.unionByName(g)
    return out.select(F.col("bin").alias("container_id"), F.inline("parts"))


def fill(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row: containers, the fewest any packing could need for their tokens, and the share of space used."""
    each = packed.groupBy("container_id").agg(F.sum("n_tokens").alias("n"))
    total = F.coalesce(F.sum("n"), F.lit(0))
    return each.agg(F.count("*").alias("n_containers"), F.ceil(total / capacity).alias("bound"), total.alias("n_tokens"), (total / (F.count("*") * capacity)).alias("share"))


def p9_containers(spark, sf: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf}/documents.parquet"))


def p9_fill(spark, sf: str) -> DataFrame:
    return fill(p9_containers(spark, sf))
