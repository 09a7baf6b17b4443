"""Oversized documents into pieces under a token limit, cut at natural boundaries, with an overlap.

Byte-range processing. A text is taken apart into ranges of fixed size with halos of its
neighbours on both sides, in the scan and without a worker ever holding it whole. A range
owns the units (stretches no pretoken leaves) that begin in it, and yields a table of its
possible cuts (place, tokens so far, how natural). Where a single unit outgrows the halo, a
table of the ranges' last boundaries is stitched first, so that each range knows where the
unit began. Range totals are prefix-summed per document, so every range knows the document's
token count at each of its cuts. Piece k ends at the most natural cut whose count lies in
((k+1)*stride - slack, (k+1)*stride]: every end is found without its predecessors, from the
cuts of the ranges the window touches. Pieces are then taken from the ranges by offset. A
text of one range takes the same way, only without the stitching.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionloom.functions.plan import let
from sessionloom.llm import bpe
from sessionloom.llm.budget import FREE
from sessionloom.session import written

LIMIT, OVERLAP, SLACK = 1024, 64, 128
#: Characters of a range.
RANGE = 1 << 18
#: A run without a place to cut is cut after so many characters, but only where it must be.
RUN = 24
#: Characters from which a unit is a giant: it may be shared by ranges. A run of this length has
#: more than 8 tokens, whatever the vocabulary (its longest token has 128 bytes).
GIANT = 2048
#: Characters of its neighbours a range sees.
LEFT, RIGHT = GIANT + 8, 2 * GIANT + 64
#: Most tokens between two places to cut: a run of RUN characters or two short ones.
GAP = 160

_SENTENCE, _CLAUSE = ".!?。！？…؟।", ",;:，；、：،)"
# How natural a cut is.
PARAGRAPH, LINE, SENTENCE, CLAUSE, WORD, CLASS, FORCED = 6, 5, 4, 3, 2, 1, 0

_SPACE, _PLAIN, _STOP, _PAUSE, _WIDE_STOP, _WIDE_PAUSE, _QUOTE = range(7)


def _end(w: str) -> int:
    """How a pretoken ends."""
    last = w[-1]
    if last.isspace():
        return _SPACE
    if last == "'" or (w[0] == "'" and last.isalpha()):
        return _QUOTE
    if last in _SENTENCE:
        return _STOP if last in ".!?" else _WIDE_STOP
    return _PLAIN if last not in _CLAUSE else _PAUSE if last in ",;:)" else _WIDE_PAUSE


def _begin(w: str) -> int:
    """How a pretoken begins: 0 no white space, 1 blank, 2 one line break, 3 more."""
    return 0 if not w[0].isspace() else 1 + min(2, w.count("\n", 0, GIANT))


def _notes(tool: bpe.Bpe) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each numbered pretoken: characters, how it ends, how it begins, tokens. Once per batch of
    texts, and only for pretokens that weren't noted before."""
    old = tool.notes.get("cuts", (np.zeros(0, np.int64), np.zeros(0, np.int8), np.zeros(0, np.int8)))
    fresh = list(itertools.islice(tool.known, len(old[0]), None))
    new = [map(len, fresh), map(_end, fresh), map(_begin, fresh)]
    tool.notes["cuts"] = tuple(np.append(o, np.fromiter(n, o.dtype, len(fresh))) for o, n in zip(old, new)) if fresh else old
    return *tool.notes["cuts"], tool.sizes()


class Owned:
    """What a range owns of its text: parts of a giant begun before it, whole units, parts of a giant begun in it."""

    __slots__ = ("begin", "head", "head_ends", "text", "tail", "tail_ends", "tail_begin", "after", "ends", "more")


def _last_cut(text: str, low: int, high: int) -> int | None:
    """The last free place in [low, high)."""
    for back in (64, 1024, high - low):
        found = None
        for m in FREE.finditer(text, max(low, high - back), min(len(text), high + 2)):
            if m.start() < high:
                found = m.start()
        if found is not None or high - back <= low:
            return found
    return None


def giant_start(text: str, at: int) -> int:
    """Where the run of a giant unit begins: after a leading white space or contraction."""
    words = bpe.pretokens(text[at : at + 64])
    return at + sum(map(len, words[:-1]))


def owned(part: str, left: int, begin: int, size: int, length: int, carry: int | None) -> Owned:
    """Of the range [begin, begin + size) of a text of ``length`` characters, seen as ``part`` from
    ``left`` on; ``carry`` is where a giant that began before the halo starts."""
    o = Owned()
    o.head, o.tail, o.text, o.head_ends, o.tail_ends, o.tail_begin, o.after, o.ends, o.more = [], [], "", False, False, 0, 1, False, False
    b, e, whole = begin - left, min(begin + size, length) - left, left + len(part) == length
    o.begin = b

    def next_cut(at: int) -> int | None:
        m = FREE.search(part, at) if at < len(part) else None
        return m.start() if m else len(part) if whole else None

    def grid(start: int, low: int, high: int, stop: int | None) -> tuple[int, list[str], bool]:
        """Where the first part begins, the parts that begin in [low, high), and whether the giant ends with them."""
        first = max(start, start + -(-(low - start) // RUN) * RUN)
        parts = [part[s : min(s + RUN, stop if stop is not None else len(part))] for s in range(first, high, RUN)]
        return first, parts, bool(parts) and first + sum(map(len, parts)) == stop

    def close(stop: int | None) -> None:
        """What follows all that is owned, which ends at ``stop`` (None: inside a giant)."""
        o.ends = whole and stop == len(part)
        o.after = _after(part, stop) if stop is not None else 0

    first = 0 if begin == 0 else next_cut(b)
    if begin and first != b:
        above = _last_cut(part, max(0, b - LEFT), b)
        above = 0 if above is None and left == 0 else above
        start = giant_start(part, above) if above is not None else carry - left
        if first is None or first - start > GIANT:
            at, o.head, o.head_ends = grid(start, b, e if first is None else min(e, first), first)
            o.begin = at if o.head else b
    if first is None or first >= e:
        if o.head:
            close(first if o.head_ends else None)
        return o
    o.begin = o.begin if o.head else first
    stop = next_cut(e)
    if stop == e:
        o.text = part[first:e]
        close(e)
        return o
    top = _last_cut(part, first, e)
    start = giant_start(part, first if top is None else top)
    if stop is not None and stop - start <= GIANT:
        o.text = part[first:stop]
        close(stop)
        return o
    # a white space before the giant is read with what follows it; that last pretoken is dropped again
    o.more = start > (first if top is None else top)
    o.text = part[first : start + 2 * o.more]
    _, o.tail, o.tail_ends = grid(start, start, e, stop)
    o.tail_begin = _begin(part[start : start + GIANT])
    if not o.tail:  # only the giant's short beginning lies in this range
        o.after = o.tail_begin
    else:
        close(stop if o.tail_ends else None)
    return o


def _after(part: str, at: int) -> int:
    """How what follows a place begins."""
    return _begin(bpe.pretokens(part[at : at + GIANT])[0]) if at < len(part) else 1


def cut_table(tool: bpe.Bpe, notes: tuple, o: Owned, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int, int]:
    """Places after which a piece may end, the tokens before each, how natural each is, all tokens
    when every long run is cut, and all tokens when only giants are.

    At every place but a forced one the tokens of both sides are those of the whole.
    Forced ones lie inside a long run; their counts are those of its pieces, one by one.
    """
    size, end, begin, n = (x[numbers] for x in notes)
    forced = np.zeros(len(size), bool)
    for parts, ends, first, front in ((o.head, o.head_ends, 0, True), (o.tail, o.tail_ends, o.tail_begin, False)):
        if parts:
            k = len(parts)
            inner = np.arange(k) < k - ends
            more = (
                np.fromiter(map(len, parts), size.dtype, k), np.where(inner, _PLAIN, _end(parts[-1])).astype(end.dtype), np.where(np.arange(k) == 0, first, 0).astype(begin.dtype), np.array(tool.count_single(parts), n.dtype), inner,
            )
            size, end, begin, n, forced = (np.append(m, x) if front else np.append(x, m) for x, m in zip((size, end, begin, n, forced), more))
    if not len(size):
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.int8), 0, 0
    stops = np.cumsum(size)
    long = np.flatnonzero((n > 8) & (size > RUN))
    extra_at, extra_n, extra_of = [], [], []
    shift = sum(map(len, o.head))
    n = n.copy()
    uncut = n.copy()
    for k in long.tolist():
        a, b = int(stops[k] - size[k]), int(stops[k])
        run = o.text[a - shift : b - shift]
        parts = [run[i : i + RUN] for i in range(0, len(run), RUN)]
        counts = np.cumsum(tool.count_single(parts))
        n[k] = counts[-1]
        if size[k] > GIANT:
            uncut[k] = n[k]
        extra_at += [a + RUN * (i + 1) for i in range(len(parts) - 1)]
        extra_n += counts[:-1].tolist()
        extra_of += [k] * (len(parts) - 1)
    tokens = np.cumsum(n)
    after = np.append(begin[1:], o.after)
    wide = np.where(end == _WIDE_STOP, SENTENCE, np.where(end == _WIDE_PAUSE, CLAUSE, np.where(end == _QUOTE, FORCED, CLASS)))
    blank = np.where((end == _STOP) | (end == _WIDE_STOP), SENTENCE, np.where((end == _PAUSE) | (end == _WIDE_PAUSE), CLAUSE, WORD))
    level = np.where(after == 3, PARAGRAPH, np.where(after == 2, LINE, np.where(after == 1, blank, wide)))
    level[forced] = FORCED
    fits = forced | (end != _SPACE)
    fits[-1] |= o.ends
    at, total, level = stops[fits], tokens[fits], level[fits]
    if extra_at:
        base = (tokens - n)[extra_of] + np.array(extra_n)
        at, total, level = np.append(at, extra_at), np.append(total, base), np.append(level, np.zeros(len(extra_at), level.dtype))
        order = np.argsort(at, kind="stable")
        at, total, level = at[order], total[order], level[order]
    return at + o.begin, total, level.astype(np.int8), int(tokens[-1]), int(uncut.sum())


def piece_ends(at: np.ndarray, tokens: np.ndarray, level: np.ndarray, stride: int, slack: int, overlap: int):
    """(piece_no, end, tokens there, start of the next piece, tokens there) of a whole text's pieces."""
    last = -(-int(tokens[-1]) // stride) - 1
    tops = (np.arange(last) + 1) * stride
    low, high = np.searchsorted(tokens, tops - slack, "right"), np.searchsorted(tokens, tops, "right")
    for k in range(last + 1):
        if k == last:
            i = len(at) - 1
        else:
            a, b = low[k], high[k]
            # a single token-rich unit spans the window: the place before it
            i = max(0, b - 1) if a == b else b - 1 - int(np.argmax(level[a:b][::-1]))
        have = tokens[i] - overlap
        j = int(np.searchsorted(tokens, have, "left")) if have > 0 else None
        yield k, int(at[i]), int(tokens[i]), *((0, 0) if j is None else (int(at[j]), int(tokens[j])))


def _tables(batch: pa.RecordBatch, tool: bpe.Bpe, size: int):
    """(row, what it owns, its pretokens' numbers, notes) of each range of a batch with the columns part, left, begin, length and carry."""
    part = batch.column("part")
    facts = list(zip(*(batch.column(c).to_pylist() for c in ("left", "begin", "length", "carry"))))
    for low, high in bpe.batches_of(part):
        texts = part.slice(low, high - low).to_pylist()
        mine = [owned(t, *facts[low + i][:2], size, *facts[low + i][2:]) for i, t in enumerate(texts)]
        numbers = tool.number([o.text for o in mine])
        notes = _notes(tool)
        for i, (o, own) in enumerate(zip(mine, numbers)):
            yield low + i, o, own[: len(own) - o.more], notes


def _batch(batch: pa.RecordBatch, key: str, rows: list[list], names: tuple, types: tuple) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([batch.column(key).take(pa.array(rows[0], pa.int64())), *[pa.array(c, t) for c, t in zip(rows[1:], types)]], names=[key, *names])


def _ranges(text: Column, size: int) -> Column:
    """array<struct<range_no, left, begin, part>>: the text in chunks of ``size``, each with its halos."""
    # possessive: the greedy form recurses where characters of one and two UTF-16 units alternate
    chunks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}+"), F.lit(0))
    before, behind = -(-LEFT // size), -(-RIGHT // size)

    def with_halo(cs: Column) -> Column:
        def one(c: Column, i: Column) -> Column:
            low = F.greatest(i - before, F.lit(0))
            left = F.array_join(F.slice(cs, low + 1, i - low), "")
            right = F.array_join(F.slice(cs, i + 2, F.lit(behind)), "")
            kept = F.least(F.length(left), F.lit(LEFT))
            begin = i.cast("bigint") * size
            return F.struct(i.alias("range_no"), (begin - kept).alias("left"), begin.alias("begin"), F.concat(F.when(kept > 0, F.substring(left, -kept, kept)).otherwise(""), c, F.substring(right, 1, RIGHT)).alias("part"))

        return F.transform(cs, one)

    return let(chunks, with_halo)


def split(docs: DataFrame, key: str = "doc_id", text: str = "text", limit: int = LIMIT, overlap: int = OVERLAP, slack: int = SLACK, path: str | None = None, size: int = RANGE) -> DataFrame:
    """(key, piece_no, start_at, end_at, n_tokens, overlap_tokens, piece) of every document longer than ``limit`` tokens.

    Pieces are consecutive, each but the first begins with the last ``overlap`` tokens of
    its predecessor (fewer only where no cut lies there), and none exceeds the limit: at
    most overlap + slack + stride = limit. A run without any place to cut, such as a long
    string of letters, is cut inside. Null, empty and short texts give no rows; repeated rows
    are split each. Positions count code points. ``size``, the characters of a range, changes
    how the work is spread, never the pieces.
    """
    path = path or bpe.default_path()
    stride = limit - overlap - slack
    if stride <= 0 or slack < 1 or overlap < 0:
        raise ValueError("limit must exceed overlap + slack")
    kind = dict(docs.dtypes)[key]
    length = F.length(text)
    names, types = ("piece_no", "start_at", "end_at", "n_tokens", "overlap_tokens"), (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32())

    def single(batches):
        """A text of one range: its table gives its pieces at once."""
        tool = bpe.load(path)
        for batch in batches:
            rows: list[list] = [[] for _ in range(7)]
            text_of = batch.column("part")
            for row, o, own, notes in _tables(batch, tool, size):
                if notes[3][own].sum() <= limit and not (notes[0][own] > GIANT).any():
                    continue
                at, tokens, level, _, total = cut_table(tool, notes, o, own)
                if total <= limit:
                    continue
                whole = text_of[row].as_py()
                start = have = prev = 0
                for k, stop, upto, nxt, there in piece_ends(at, tokens, level, stride, slack, overlap):
                    for col, v in zip(rows, (row, k, start, stop, upto - have, prev - have if k else 0, whole[start:stop])):
                        col.append(v)
                    start, have, prev = nxt, there, upto
            yield _batch(batch, key, rows, (*names, "piece"), (*types, pa.string()))

    slim = docs.select(key, text)
    spec = f"`{key}` {kind}, piece_no int, start_at bigint, end_at bigint, n_tokens int, overlap_tokens int, piece string"
    short = slim.where(length.between(1, size)).select(key, F.lit(0).cast("bigint").alias("left"), F.lit(0).cast("bigint").alias("begin"), length.cast("bigint").alias("length"), F.lit(None).cast("bigint").alias("carry"), F.col(text).alias("part"))
    short = short.mapInArrow(single, spec)
    # a row is its own document, also where another row repeats its key
    big = slim.where(length > size).select(F.struct(F.col(key).alias("k"), F.monotonically_increasing_id().alias("row")).alias("_doc"), length.cast("bigint").alias("length"), F.col(text).alias("_text"))
    ranged = _ranged(big, f"struct<k:{kind},row:bigint>", limit, overlap, slack, stride, path, size)
    return short.unionByName(ranged.select(F.col("_doc.k").alias(key), *[c for c in ranged.columns if c != "_doc"]))


def _ranged(big: DataFrame, kind: str, limit: int, overlap: int, slack: int, stride: int, path: str, size: int) -> DataFrame:
    """Texts of several ranges."""
    cut = big.select("_doc", "length", F.inline(_ranges(F.col("_text"), size)))
    ranges = written(cut.repartition(F.xxhash64("_doc", "range_no")), "ranges")

    def boundaries(batches):
        """Where the run that leaves each range begins, null where the range is inside one."""
        for batch in batches:
            found = []
            for part, left, begin, length in zip(*(batch.column(c).to_pylist() for c in ("part", "left", "begin", "length"))):
                low, high = begin - left, min(begin + size, length) - left
                at = _last_cut(part, low, high)
                at = 0 if at is None and begin == 0 else at
                found.append(None if at is None else left + giant_start(part, at))
            yield pa.RecordBatch.from_arrays([batch.column("_doc"), batch.column("range_no"), pa.array(found, pa.int64())], names=["_doc", "range_no", "start"])

    def tables(batches):
        tool = bpe.load(path)
        types = (pa.int32(), pa.int64(), pa.int64(), *[pa.list_(pa.int64())] * 2, pa.list_(pa.int8()))
        for batch in batches:
            rows: list[list] = [[] for _ in range(7)]
            left, number = batch.column("left").to_pylist(), batch.column("range_no").to_pylist()
            for row, o, own, notes in _tables(batch, tool, size):
                at, tokens, level, total, uncut = cut_table(tool, notes, o, own)
                for col, v in zip(rows, (row, number[row], total, uncut, at + left[row], tokens, level)):
                    col.append(v)
            yield _batch(batch, "_doc", rows, ("range_no", "n", "uncut", "at", "tokens", "level"), types)

    seen = ranges.select("_doc", "range_no", "left", "begin", "length", "part").mapInArrow(boundaries, f"_doc {kind}, range_no int, start bigint")
    along = Window.partitionBy("_doc").orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    carry = seen.select("_doc", "range_no", F.last("start", ignorenulls=True).over(along).alias("carry"))
    read = ranges.join(carry, ["_doc", "range_no"]).select("_doc", "range_no", "left", "begin", "length", "carry", "part")
    made = written(read.mapInArrow(tables, f"_doc {kind}, range_no int, n bigint, uncut bigint, at array<bigint>, tokens array<bigint>, level array<tinyint>"), "cuts")
    # stitch: one row per range, only totals
    totals = made.groupBy("_doc").agg(F.sum("n").alias("total"), F.sum("uncut").alias("uncut")).where(F.col("uncut") > limit).drop("uncut")
    low = F.coalesce(F.sum("n").over(along), F.lit(0))
    placed = made.drop("uncut").join(made.select("_doc", "range_no", low.alias("low")), ["_doc", "range_no"]).join(totals, "_doc")
    # each range gives the cuts of its windows: of piece k those in (top - slack - overlap - GAP, top]
    reach = slack + overlap + GAP
    cuts = F.zip_with(F.arrays_zip("tokens", "at"), "level", lambda x, v: F.struct((x["tokens"] + F.col("low")).alias("t"), x["at"].alias("at"), v.alias("level")))
    last = F.ceil(F.col("total") / stride).cast("bigint") - 1
    first_k = F.greatest(F.floor((F.col("low")) / stride).cast("bigint"), F.lit(0))
    last_k = F.least(F.floor((F.col("low") + F.col("n") + reach) / stride).cast("bigint"), last)
    windows = placed.withColumns({"cuts": cuts, "last": last}).where(first_k <= last_k).select("_doc", "total", "last", "cuts", F.explode(F.sequence(first_k, last_k)).alias("k"))
    top = F.when(F.col("k") == F.col("last"), F.col("total")).otherwise((F.col("k") + 1) * stride)
    windows = windows.select("_doc", F.col("k").cast("int").alias("piece_no"), top.alias("top"), (F.col("k") == F.col("last")).alias("final"), F.filter("cuts", lambda x: (x["t"] > top - reach) & (x["t"] <= top)).alias("cuts")).where(F.size("cuts") > 0)
    sides = windows.groupBy("_doc", "piece_no", "top", "final").agg(F.flatten(F.collect_list("cuts")).alias("c"))
    inside = F.filter("c", lambda x: x["t"] > F.col("top") - slack)
    best = F.array_max(F.transform(inside, lambda x: F.struct(x["level"].alias("level"), x["t"].alias("t"), x["at"].alias("at"))))
    latest = F.array_max(F.transform("c", lambda x: F.struct(x["t"].alias("t"), x["at"].alias("at"))))
    pick = F.when(~F.col("final") & (F.size(inside) > 0), F.struct(best["t"].alias("t"), best["at"].alias("at"))).otherwise(latest)
    ends = sides.select("_doc", "piece_no", "c", pick.alias("e"))
    back = F.array_min(F.transform(F.filter("c", lambda x: x["t"] >= F.col("e.t") - overlap), lambda x: F.struct(x["t"].alias("t"), x["at"].alias("at"))))
    zero = F.lit(0).cast("bigint")
    start = F.when(F.col("e.t") <= overlap, F.struct(zero.alias("t"), zero.alias("at"))).otherwise(back)
    ends = written(ends.select("_doc", "piece_no", "e", start.alias("s")), "ends")
    order = Window.partitionBy("_doc").orderBy("piece_no")
    begin, have, prev = (F.coalesce(F.lag(c).over(order), F.lit(0)) for c in ("s.at", "s.t", "e.t"))
    pieces = ends.select("_doc", "piece_no", begin.alias("start_at"), F.col("e.at").alias("end_at"), (F.col("e.t") - have).cast("int").alias("n_tokens"), (prev - have).cast("int").alias("overlap_tokens"))
    # a piece's text, from the ranges it touches
    touched = pieces.withColumn("range_no", F.explode(F.sequence(F.floor(F.col("start_at") / size), F.floor((F.col("end_at") - 1) / size)))).withColumn("range_no", F.col("range_no").cast("int"))
    hit = touched.join(ranges.select("_doc", "range_no", "left", "begin", "part"), ["_doc", "range_no"])
    a, b = F.greatest("start_at", "begin"), F.least(F.col("end_at"), F.col("begin") + size)
    some = F.struct("range_no", F.substring(F.col("part"), (a - F.col("left") + 1).cast("int"), (b - a).cast("int")).alias("t"))
    joined = hit.groupBy("_doc", "piece_no", "start_at", "end_at", "n_tokens", "overlap_tokens").agg(F.array_sort(F.collect_list(some)).alias("c"))
    return joined.select("_doc", "piece_no", "start_at", "end_at", "n_tokens", "overlap_tokens", F.array_join(F.col("c.t"), "").alias("piece"))


def p10_pieces(spark, sf: str) -> DataFrame:
    return split(spark.read.parquet(f"{sf}/documents.parquet"))


def p10_ranges(spark, sf: str) -> DataFrame:
    """The same pieces from ranges of 4,096 characters, without their texts: most documents are stitched."""
    return split(spark.read.parquet(f"{sf}/documents.parquet"), size=4096).drop("piece")
