"""Parent-child rows to roots, depths, paths and descendants, with cycles found.

Tree contraction. Rows are first contracted within fixed blocks of their arrival
order: every node hangs below the highest ancestor inside its block (its
fragment's top), at a known distance, so a whole fragment is raked into one node
in a single local step. The remaining graph of fragments is contracted in rounds,
each of which rakes all leaves and splices out an independent set of the nodes
with one child. Each removal is recorded with the node it hangs from; replaying
the records backwards gives every node its root and distance. A node that comes
to be its own parent is what is left of a cycle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionloom.session import drop_written, written

CYCLE = "cycle"
#: Rows of one block of arrival order. A block is the unit of local work and fits a task's memory.
BLOCK_ROWS = 100_000
#: Most ids in one piece of a path, and rows of a block in which pieces are built.
PIECE_IDS, PIECE_BLOCK_ROWS = 64, 25_000
_CANON = "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"


def normal_id(c: Column) -> Column:
    """Lower case without outer blanks; null where nothing is left."""
    t = F.lower(F.regexp_replace(c, r"^\s+|\s+$", ""))
    return F.when(F.length(t) > 0, t)


def pack_id(c: Column) -> Column:
    """A lossless short key: the 16 bytes of a canonical uuid, other texts as they are (never 16 bytes: they end in a mark)."""
    return F.when(c.rlike(_CANON), F.unhex(F.regexp_replace(c, "-", ""))).otherwise(F.encode(F.concat(c, F.lit("\u0001" * 17)), "utf-8"))


def unpack_id(c: Column) -> Column:
    h = F.lower(F.hex(c))
    dashed = F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4), F.substring(h, 21, 12))
    text = F.decode(c, "utf-8")
    return F.when(F.octet_length(c) == 16, dashed).otherwise(F.substring(text, F.lit(1), F.length(text) - 17))


def _fragments(key: tuple, table: pa.Table) -> pa.Table:
    """One block: each node's top (the last ancestor inside the block), its distance, the
    top's outside parent (null for a root). Nodes on or below a cycle inside the block have
    distance -1. Doubling needs log2(longest chain) vector steps."""
    ids = table.column("id").combine_chunks()
    n = len(ids)
    index = pc.index_in
    at = index(table.column("parent").combine_chunks(), value_set=ids)
    up = np.asarray(at.fill_null(-1).to_numpy(zero_copy_only=False), dtype=np.int64)
    up[np.asarray(table.column("parent").is_null())] = -1
    me = np.arange(n)
    ptr = np.where(up < 0, me, up)
    dist = (up >= 0).astype(np.int64)
    for _ in range(max(1, int(n).bit_length()) + 1):
        nxt = ptr[ptr]
        if (nxt == ptr).all():
            break
        dist = dist + np.where(nxt != ptr, dist[ptr], 0)
        ptr = nxt
    looped = up[ptr] >= 0
    dist[looped] = -1
    top = np.where(looped, me, ptr)
    return pa.table({"id": ids, "top": ids.take(pa.array(top)), "dist": pa.array(dist), "out": table.column("parent").combine_chunks().take(pa.array(np.where(looped, me, ptr)))})


def _coin(c: Column, turn: int) -> Column:
    return F.xxhash64(c, F.lit(turn)) % 2 == 0


def contract(nodes: DataFrame, block_rows: int = BLOCK_ROWS, rounds: int = 400) -> DataFrame:
    """(id binary, root binary, depth int) of (id binary unique, parent binary, ord bigint).

    A parent that is null or no id makes a root. Nodes on or below a cycle get a null
    root and depth -1. ``ord`` is any number under which relatives tend to be close;
    it decides only how much is done locally, never the result.
    """
    blocks = nodes.select("id", "parent", F.floor(F.col("ord") / block_rows).alias("block"))
    frag = written(blocks.groupBy("block").applyInArrow(_fragments, "id binary, top binary, dist bigint, out binary"), "fragments")
    tops = frag.where("id = top and dist >= 0 and out is not null").select("id", "out")
    # where the outside parent sits: its own fragment's top, or nowhere (then this top is a root)
    place = frag.select(F.col("id").alias("out"), F.col("top").alias("p"), F.col("dist").alias("pd"))
    linked = tops.join(place, "out").select("id", "p", F.when(F.col("pd") < 0, F.lit(-1)).otherwise(F.col("pd") + 1).alias("w"))
    graph = written(linked, "graph")
    trash, records, left = [frag, graph], [], graph.count()
    # what hangs below a cycle inside a block is settled; the rest is (id, p, w)
    solved = graph.where("w < 0").select("id", F.lit(None).cast("binary").alias("root"), F.lit(-1).cast("bigint").alias("d"))
    graph = graph.where("w >= 0")
    turn = 0
    while left and turn < rounds:
        kids = graph.groupBy(F.col("p").alias("id")).agg(F.count("*").alias("kids"))
        state = graph.join(kids, "id", "left").select("id", "p", "w", F.coalesce("kids", F.lit(0)).alias("kids"))
        loop = F.col("id") == F.col("p")
        # a spliced node is never the parent of another one: it shows heads, its parent tails
        step = F.when(loop, "loop").when(F.col("kids") == 0, "rake").when((F.col("kids") == 1) & _coin(F.col("id"), turn) & ~_coin(F.col("p"), turn), "splice").otherwise("keep")
        state = written(state.select("id", "p", "w", step.alias("step")), "round")
        spliced = state.where("step = 'splice'").select(F.col("id").alias("p"), F.col("p").alias("pp"), F.col("w").alias("pw"))
        stay = state.where("step = 'keep'").join(spliced, "p", "left")
        graph_next = written(stay.select("id", F.coalesce("pp", "p").alias("p"), (F.col("w") + F.coalesce("pw", F.lit(0))).alias("w")), "graph")
        records.append(state)
        trash += [state, graph_next]
        graph, turn, left = graph_next, turn + 1, graph_next.count()
    if left:
        raise RuntimeError(f"contraction did not end after {rounds} rounds")
    # backwards: the loops of all rounds first, since what hangs below one may be raked in any
    # later round; then what was raked or spliced from what is settled or a root
    done = solved
    for state in records:
        loops = state.where("step = 'loop'").select("id", F.lit(None).cast("binary").alias("root"), F.lit(-1).cast("bigint").alias("d"))
        done = done.unionByName(loops)
    for state in reversed(records):
        for step in ("splice", "rake"):
            hung = state.where(F.col("step") == step).select("id", "p", "w")
            at = done.withColumnRenamed("id", "p").withColumn("hit", F.lit(True))
            hung = hung.join(at, "p", "left").select(
                "id",
                F.when(F.col("hit"), F.col("root")).otherwise(F.col("p")).alias("root"),
                F.when(F.col("hit"), F.when(F.col("d") < 0, F.lit(-1)).otherwise(F.col("d") + F.col("w"))).otherwise(F.col("w")).cast("bigint").alias("d"),
            )
            done = done.unionByName(hung)
        done = written(done, "replay")
        trash.append(done)
    at = done.withColumnRenamed("id", "top").withColumn("hit", F.lit(True))
    out = frag.join(at, "top", "left").select(
        "id",
        F.when(F.col("dist") < 0, None).when(F.col("hit"), F.col("root")).otherwise(F.col("top")).alias("root"),
        F.when((F.col("dist") < 0) | (F.col("hit") & (F.col("d") < 0)), F.lit(-1)).otherwise(F.col("dist") + F.coalesce("d", F.lit(0))).cast("int").alias("depth"),
    )
    for t in trash[2:]:  # the first two and the last replay are still read by the result
        if t is not done:
            drop_written(t)
    return out


def _nodes(df: DataFrame, id_col: str, parent_col: str, order_col: str | None) -> DataFrame:
    """(id, parent, ord) of each distinct normalised id, as ``contract`` takes them."""
    order = F.col(order_col).cast("bigint") if order_col else F.monotonically_increasing_id()
    rows = df.select(normal_id(F.col(id_col)).alias("id"), normal_id(F.col(parent_col)).alias("parent"), F.coalesce(order, F.lit(0)).alias("ord")).where("id is not null")
    nodes = rows.select(pack_id(F.col("id")).alias("id"), pack_id(F.col("parent")).alias("parent"), "ord")
    return nodes.groupBy("id").agg(F.min_by("parent", F.when(F.col("parent").isNotNull(), F.col("ord"))).alias("parent"), F.min("ord").alias("ord"))


def hierarchy(df: DataFrame, id_col: str, parent_col: str, order_col: str | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(uuid, root_uuid, depth): one row per distinct normalised id of ``df``.

    Null and blank ids are no nodes. Of repeated rows of one id the parent of the first
    (by ``order_col``) that names one holds. Entries on or below a cycle have root
    ``cycle`` and depth -1. An empty table gives an empty result; other columns of
    ``df`` are not read, whatever their names.
    """
    nodes = _nodes(df, id_col, parent_col, order_col)
    done = contract(nodes, block_rows)
    return done.select(
        unpack_id(F.col("id")).alias("uuid"),
        F.when(F.col("depth") < 0, F.lit(CYCLE)).otherwise(unpack_id(F.col("root"))).alias("root_uuid"),
        "depth",
    )


def _pieces(key: tuple, table: pa.Table) -> pa.Table:
    """One block: the end of each node's path, from its piece's head to itself. A node is a head
    at every PIECE_IDS-th depth and where its parent is outside the block."""
    table = table.combine_chunks()
    ids, depth, step = table.column("id").combine_chunks(), table.column("depth").to_numpy(), int(table.column("step")[0].as_py())
    at = pc.index_in(table.column("parent").combine_chunks(), value_set=ids)
    up = np.asarray(at.fill_null(-1).to_numpy(zero_copy_only=False), dtype=np.int64)
    up[np.asarray(table.column("parent").is_null()) | (depth % step == 0)] = -1
    n = len(ids)
    cur, head, size = np.arange(n), np.arange(n), np.zeros(n, dtype=np.int64)
    while (on := cur >= 0).any():
        size += on
        head = np.where(on, cur, head)
        cur = np.where(on, up[cur], -1)
    ends = np.cumsum(size)
    flat = np.empty(int(ends[-1]) if n else 0, dtype=np.int64)
    cur, back = np.arange(n), 1
    while (on := np.flatnonzero(cur >= 0)).size:
        flat[ends[on] - back] = cur[on]
        cur[on] = up[cur[on]]
        back += 1
    uuid = table.column("uuid").combine_chunks()
    path = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), uuid.take(pa.array(flat)))
    top = pa.array(head)
    out = pc.if_else(pa.array(depth[head] == 0), pa.scalar(None, pa.binary()), table.column("parent").combine_chunks().take(top))
    return pa.table({"id": ids, "uuid": uuid, "root": table.column("root"), "depth": table.column("depth"), "head": ids.take(top), "out": out, "first": pa.array(depth - size + 1, pa.int32()), "path": path})


def paths(df: DataFrame, id_col: str, parent_col: str, order_col: str | None = None, block_rows: int = BLOCK_ROWS, piece_ids: int = PIECE_IDS, piece_block: int = PIECE_BLOCK_ROWS) -> DataFrame:
    """(uuid, root_uuid, depth, first_depth, path): the full path of every node of :func:`hierarchy`, from root to itself, in pieces.

    A piece holds at most ``piece_ids`` ids, ``first_depth`` is the depth of its first one; the
    pieces of a uuid in that order are its path, whatever its length. Entries on or below a cycle
    have root ``cycle``, depth and first_depth -1 and one empty piece.
    """
    nodes = written(_nodes(df, id_col, parent_col, order_col), "nodes")
    placed = written(nodes.join(contract(nodes, block_rows), "id"), "placed")
    block = F.floor(F.col("ord") / piece_block)
    live = placed.where("depth >= 0").select("id", "parent", "root", "depth", unpack_id(F.col("id")).alias("uuid"), block.alias("block"), F.lit(piece_ids).alias("step"))
    piece = written(live.groupBy("block").applyInArrow(_pieces, "id binary, uuid string, root binary, depth int, head binary, out binary, first int, path array<string>"), "pieces")
    # (head, out, up, n): the n-th piece above a head's ends at the node out and has the head up
    above = piece.select(F.col("id").alias("out"), F.col("head").alias("up"))
    reach = written(piece.where("id = head and out is not null").select("head", "out").join(above, "out").select("head", "out", "up", F.lit(1).alias("n")), "reach")
    far = 1
    while True:  # doubling: after a step, all within 2 * far pieces
        more = reach.where(F.col("n") == far).select("head", F.col("up").alias("mid"), "n").join(reach.select(F.col("head").alias("mid"), "out", "up", F.col("n").alias("m")), "mid")
        more = written(more.select("head", "out", "up", (F.col("n") + F.col("m")).alias("n")), "reach")
        if more.isEmpty():
            break
        reach, far = reach.unionByName(more), far * 2
    upper = reach.select("head", F.col("out").alias("id")).join(piece.select("id", "first", "path"), "id").drop("id")
    rest = piece.select("uuid", "root", "depth", "head").join(upper, "head")
    out = piece.select("uuid", "root", "depth", "first", "path").unionByName(rest.select("uuid", "root", "depth", "first", "path"))
    looped = placed.where("depth < 0").select(unpack_id(F.col("id")), F.lit(CYCLE), "depth", F.lit(-1), F.array().cast("array<string>"))
    return out.select("uuid", unpack_id(F.col("root")).alias("root_uuid"), "depth", F.col("first").alias("first_depth"), "path").union(looped)


def descendants(pieces: DataFrame) -> DataFrame:
    """(uuid, descendant, distance): one row for each entry below an entry, of :func:`paths`."""
    each = pieces.select(F.col("uuid").alias("descendant"), "depth", "first_depth", F.posexplode("path").alias("pos", "uuid"))
    distance = F.col("depth") - F.col("first_depth") - F.col("pos")
    return each.select("uuid", "descendant", distance.alias("distance")).where("distance > 0")


def entry_parents(entries: DataFrame) -> DataFrame:
    """(uuid, parent, row_id) of log entries with the links between files filled in.

    The first entry of a file (lowest line_no with a uuid; of several on that line
    the earliest row) that names no parent hangs below the entry named by leafUuid in
    the file's summary row (the first such row), unless that entry is in the file too.
    """
    e = entries.select("file_path", F.col("line_no"), "row_id", normal_id(F.col("uuid")).alias("uuid"), normal_id(F.col("parentUuid")).alias("parent"), normal_id(F.col("leafUuid")).alias("leaf"), F.lower(F.trim("type")).alias("type"))
    at = F.struct("line_no", "row_id")
    named = F.col("uuid").isNotNull()
    summary = (F.col("type") == "summary") & F.col("leaf").isNotNull()
    # partial aggregation keeps a file of any size to one row per map task
    heads = (
        e.groupBy("file_path")
        .agg(
            F.min_by(F.struct("uuid", "parent", "row_id"), F.when(named, at)).alias("head"),
            F.min_by("leaf", F.when(summary, at)).alias("leaf"),
        )
        .where("leaf is not null and head.uuid is not null and head.parent is null")
        .select("file_path", "leaf", F.col("head.uuid").alias("uuid"), F.col("head.row_id").alias("row_id"))
    )
    own = e.where(named).select("file_path", F.col("uuid").alias("leaf"))
    links = heads.join(own, ["file_path", "leaf"], "left_anti").select("uuid", F.col("leaf").alias("parent"), "row_id")
    return e.where(named).select("uuid", "parent", "row_id").unionByName(links)


def p5_found(spark, sf: str) -> DataFrame:
    entries = spark.read.parquet(f"{sf}/claude_entries.parquet")
    return hierarchy(entry_parents(entries), "uuid", "parent", "row_id")


def p5_contracted(spark, sf: str) -> DataFrame:
    """The rows of p5_found from blocks of 2,000 rows, so that rounds of raking and splicing run at any size."""
    entries = spark.read.parquet(f"{sf}/claude_entries.parquet")
    return hierarchy(entry_parents(entries), "uuid", "parent", "row_id", block_rows=2000)


def p5_paths(spark, sf: str) -> DataFrame:
    entries = spark.read.parquet(f"{sf}/claude_entries.parquet")
    return paths(entry_parents(entries), "uuid", "parent", "row_id")


def p5_descendants(spark, sf: str) -> DataFrame:
    return descendants(p5_paths(spark, sf))
