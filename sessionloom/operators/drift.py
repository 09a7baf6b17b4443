"""Schemas that drift between files: rescue-column ingestion and a report of each change.

``ingest`` enforces a target schema: values of exactly the target's type go to typed
columns, all others stay as JSON in ``rescued``, so every leaf of every line is found
again. ``drift_report`` reads the fields of each file off those columns and compares
them with the previous file of its stream. ``promote`` replays the rescued values of
approved fields (reported renames, and the target's own fields under another type)
into the typed columns.
"""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionloom.session import written

#: dotted field -> type of the consistent table; nested names become one column each.
TARGET = {
    "type": "string", "uuid": "string", "parentUuid": "string", "sessionId": "string", "timestamp": "string", "cwd": "string",
    "gitBranch": "string", "version": "string", "message.role": "string", "message.content": "string", "message.model": "string",
    "durationMs": "bigint", "costUSD": "double", "exitCode": "bigint", "level": "string", "requestId": "string", "isMeta": "boolean",
}
_ARROW = {"string": pa.string(), "bigint": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}
#: The JSON types of a field's values, as bits of one number.
STRING, NUMBER, BOOLEAN, ARRAY, OBJECT = 1, 2, 4, 8, 16
_BIT = {"string": STRING, "bigint": NUMBER, "double": NUMBER, "boolean": BOOLEAN}


def column_of(field: str) -> str:
    return field.replace(".", "_")


def _fits(v, kind: str) -> bool:
    """Whether a JSON value is of the target's type, so that nothing of it is lost there."""
    t = type(v)
    if kind == "string":
        return t is str
    if kind == "boolean":
        return t is bool
    if kind == "bigint":
        return t is int and -(2**63) <= v < 2**63
    return (t is float and abs(v) < float("inf")) or (t is int and abs(v) <= 2**53)


def _unique(pairs: list) -> dict:
    """An object of a line; one that repeats a key is marked by the key None."""
    o = dict(pairs)
    if len(o) != len(pairs):
        o[None] = None
    return o


def _walk(o: dict, prefix: str, target: dict, typed: dict, rescued: dict, objects: dict) -> bool:
    """Puts an object's leaves where they belong; True where two of them have one name."""
    clash = None in o and o.pop(None, True) is None
    for k, v in o.items():
        name = prefix + k
        if type(v) is dict and (len(v) > 1 or (v and None not in v)):
            clash |= name in objects
            objects[name] = ",".join(sorted(x for x in v if x is not None))
            clash |= _walk(v, name + ".", target, typed, rescued, objects)
            continue
        kind = target.get(name)
        if kind is not None and name not in typed and _fits(v, kind):
            typed[name] = v
        else:
            clash |= name in rescued
            rescued[name] = _plain_json(v)
    return clash


_decode = json.JSONDecoder(object_pairs_hook=_unique).decode


def _document(text: str):
    return _decode(text)


_encode, _quote = json.JSONEncoder(ensure_ascii=False).encode, json.encoder.encode_basestring
_WORDS = {None: "null", True: "true", False: "false"}


def _plain_json(v) -> str:
    t = type(v)
    return _quote(v) if t is str else _WORDS[v] if v is None or t is bool else _encode(v)


def ingest(lines: DataFrame, keys: list[str], line: str = "line", target: dict[str, str] = TARGET) -> DataFrame:
    """keys + one typed column per target field + rescued map<field, JSON> + objects map<field, its keys> + valid + unparsed.

    Null, blank, truncated and other invalid lines give valid = false, null columns and empty
    maps; valid JSON that is no object has no fields. The text of all of these, and of lines
    that give one name two values (a repeated key: the last one counts), is kept in ``unparsed``.
    Null values are rescued as ``null``. Objects are taken apart, empty ones and arrays are
    rescued whole. Strings with a lone surrogate are rescued in their escaped form. Rows are
    never dropped, and other columns are not read.
    """
    names = list(target)
    spec = ", ".join(f"`{column_of(n)}` {t}" for n, t in target.items())
    types = dict(lines.dtypes)
    key_spec = ", ".join(f"`{k}` {types[k]}" for k in keys)

    def read(text: str) -> tuple[dict, dict, dict, bool, bool]:
        """typed, rescued, objects, valid and whether the text itself must be kept."""
        typed: dict = {}
        rescued: dict = {}
        objects: dict = {}
        try:
            doc = _document(text)
            if not isinstance(doc, dict):
                return typed, rescued, objects, True, True
            clash = _walk(doc, "", target, typed, rescued, objects)
        except (ValueError, RecursionError):
            return {}, {}, {}, False, True
        if "\\u" in text:  # only an escape can make half a surrogate pair
            try:
                "".join([*rescued, *objects, *objects.values()]).encode()
            except UnicodeEncodeError:
                return {}, {}, {}, True, True
            for part, plain in ((typed, False), (rescued, True)):
                for k, v in list(part.items()):
                    if isinstance(v, str) and any("\ud800" <= c <= "\udfff" for c in v):
                        rescued[k] = json.dumps(json.loads(v) if plain else part.pop(k))
        return typed, rescued, objects, True, clash

    def run(batches):
        maps = pa.map_(pa.string(), pa.string())
        for batch in batches:
            texts = batch.column(len(keys)).to_pylist()
            done = [read(x) if x is not None else ({}, {}, {}, False, False) for x in texts]
            columns = [[d[0].get(n) for d in done] for n in names]
            rescued, objects, valid = [d[1] for d in done], [d[2] for d in done], [d[3] for d in done]
            kept = [x if d[4] else None for x, d in zip(texts, done)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keys)], *[pa.array(c, _ARROW[t]) for c, t in zip(columns, target.values())], _map(rescued, maps), _map(objects, maps), pa.array(valid, pa.bool_()), pa.array(kept, pa.string())],
                names=[*keys, *map(column_of, names), "rescued", "objects", "valid", "unparsed"],
            )

    schema = f"{key_spec}, {spec}, rescued map<string,string>, objects map<string,string>, valid boolean, unparsed string"
    return lines.select(*keys, line).mapInArrow(run, schema)


def _map(rows: list, kind: pa.MapType) -> pa.MapArray:
    ends, keys, values = [0], [], []
    for row in rows:
        keys += row
        values += row.values()
        ends.append(len(keys))
    return pa.MapArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys, pa.string()), pa.array(values, pa.string()), type=kind)


def _json_bit(v: Column) -> Column:
    """The type of a JSON text by its first character; 0 for null."""
    c = F.substring(v, 1, 1)
    return F.when(c == '"', STRING).when(c == "n", 0).when(c == "[", ARRAY).when(c == "{", OBJECT).when(c.isin("t", "f"), BOOLEAN).otherwise(NUMBER)


def presence(ingested: DataFrame, target: dict[str, str] = TARGET) -> DataFrame:
    """(stream, file_seq, field, kinds): the fields each file has, and their types as bits.

    Typed columns are counted as they are, and only what was rescued is exploded. Both are
    partial aggregates, so a stream with a third of all rows costs no task more than another.
    """
    at = ["stream", "file_seq"]
    named = ingested.where("stream is not null and file_seq is not null")
    counts = named.groupBy(*at).agg(*[F.count(column_of(n)).alias(column_of(n)) for n in target])
    typed = counts.select(*at, F.inline(F.array(*[F.struct(F.lit(n).alias("field"), F.lit(_BIT[t]).alias("kinds"), F.col(column_of(n)).alias("n")) for n, t in target.items()]))).where("n > 0").drop("n")
    left = F.transform(F.map_entries("rescued"), lambda e: F.struct(e["key"].alias("field"), _json_bit(e["value"]).alias("kinds")))
    whole = F.transform(F.map_keys("objects"), lambda k: F.struct(k.alias("field"), F.lit(OBJECT).alias("kinds")))
    rest = named.select(*at, F.inline(F.concat(left, whole)))
    return typed.unionByName(rest).groupBy(*at, "field").agg(F.bit_or("kinds").alias("kinds"))


def _text_of(v: Column) -> Column:
    """The string a JSON string stands for."""
    return F.when(v.contains("\\"), F.get_json_object(F.concat(F.lit('{"v":'), v, F.lit("}")), "$.v")).otherwise(F.substring(v, F.lit(2), F.length(v) - 2))


def shape_of(v: Column) -> Column:
    """What kind of text a string is: ``T`` for running text, else its classes of characters;
    null where that tells nothing."""
    running = (F.length(v) > 24) & (F.length(v) - F.length(F.replace(v, F.lit(" "), F.lit(""))) > 2)
    s = F.regexp_replace(v, "[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}", "\u0001")
    s = F.regexp_replace(s, r"\p{L}*+(?:\p{N}+\p{L}+|\p{L}+\p{N}+)[\p{L}\p{N}]*|\p{L}+\p{N}+[\p{L}\p{N}]*", "\u0002")
    s = F.regexp_replace(F.regexp_replace(s, r"\p{L}+", "a"), r"\p{N}+", "9")
    return F.when(running, "T").otherwise(F.when(~s.rlike("^[a9\u0002]?$"), s))


def evidence(ingested: DataFrame, asked: DataFrame, target: dict[str, str] = TARGET) -> DataFrame:
    """Per asked (stream, file_seq, field): counts, sketches of values and shapes, measures of numbers.

    ``asked`` are the fields that end or begin with a file; all others are left out before
    anything is sketched. A sketch is exact up to 4,096 distinct values or shapes of one file's
    field and an estimate with a standard error of about 1/64 beyond that.
    """
    at = ["stream", "file_seq"]
    text, number = F.lit(None).cast("string"), F.lit(None).cast("double")
    entry = lambda field, kind, value, num: F.struct(field.alias("field"), kind.alias("kind"), value.alias("value"), num.alias("num"))
    typed = F.array_compact(F.array(*[
        F.when(F.col(column_of(n)).isNotNull(), entry(F.lit(n), F.lit(_BIT[t]), F.col(column_of(n)) if t == "string" else text, F.col(column_of(n)).cast("double") if _BIT[t] == NUMBER else number)) for n, t in target.items()
    ]))
    left = F.transform(F.map_entries("rescued"), lambda e: entry(e["key"], _json_bit(e["value"]), e["value"], number))
    whole = F.transform(F.map_entries("objects"), lambda e: entry(e["key"], F.lit(OBJECT) + 64, e["value"], number))
    typed = F.transform(typed, lambda x: entry(x["field"], x["kind"] + 64, x["value"], x["num"]))
    rows = ingested.select(*at, F.inline(F.concat(typed, left, whole))).join(asked, [*at, "field"], "left_semi")
    raw, kind = F.col("kind") < 64, F.col("kind").bitwiseAND(63)
    elements = F.transform(F.from_json("value", "array<string>"), lambda x: F.when(x.startswith("{"), F.array_join(F.array_sort(F.json_object_keys(x)), ",")).when(x.rlike(r"^-?\d"), "number").otherwise("other"))
    # a sketch takes no notice of empty texts
    value = F.when((kind == 0) | (F.col("value") == "{}"), "").when(raw & (kind == STRING), _text_of(F.col("value"))).when(kind == ARRAY, F.array_join(F.array_sort(F.array_distinct(elements)), "|")).otherwise(F.col("value"))
    rows = rows.select(*at, "field", kind.alias("kind"), value.alias("value"), F.when(kind == NUMBER, F.coalesce("num", F.col("value").try_cast("double"))).alias("num"))
    rows = rows.withColumn("shape", F.when(F.col("kind") == STRING, shape_of(F.col("value"))))
    log, full = F.log10(1e-6 + F.abs("num")), F.when(F.col("num") == F.floor("num"), 1.0).otherwise(0.0)
    return rows.groupBy(*at, "field").agg(
        F.count("*").alias("n_rows"), F.count(F.when(F.col("kind") > 0, 1)).alias("n"),
        F.theta_sketch_agg(F.coalesce("value", F.lit(""))).alias("values"), F.theta_sketch_agg(F.coalesce("shape", F.lit(""))).alias("shapes"),
        F.count("shape").alias("n_shape"), F.count(F.when(F.col("kind") == STRING, 1)).alias("n_text"), F.avg(log).alias("mean_log"), F.avg(F.when(F.col("num").isNotNull(), full)).alias("whole"),
    )


def _est(sketch: Column) -> Column:
    return F.theta_sketch_estimate(sketch).cast("double")


def _carried(o: str, n: str, kinds: Column) -> Column:
    """0 to 1: how well the values of field ``n`` carry on those of field ``o``."""
    a, b = (lambda c: F.col(f"{o}.{c}")), (lambda c: F.col(f"{n}.{c}"))
    common = _est(F.theta_intersection(a("values"), b("values"))) / F.least(_est(a("values")), _est(b("values")))
    shape = F.when((a("n_shape") > 0.5 * a("n_text")) & (b("n_shape") > 0.5 * b("n_text")), _est(F.theta_intersection(a("shapes"), b("shapes"))) / F.least(_est(a("shapes")), _est(b("shapes"))))
    ratio = lambda c: F.least(_est(c("values")) / c("n"), F.lit(1.0))
    alike = 1 - F.abs(ratio(a) - ratio(b))
    scale = F.when(F.abs(a("mean_log") - b("mean_log")) < 0.8, 1 - 0.5 * F.abs(a("mean_log") - b("mean_log"))).otherwise(0.0)
    number = scale * (1 - F.abs(a("whole") - b("whole")))
    text = F.greatest(common, F.coalesce(shape, F.lit(0.0)) * F.when(alike > 0.5, alike).otherwise(0.0))
    has = lambda bit: kinds.bitwiseAND(bit) > 0
    return F.when((a("n") == 0) | (b("n") == 0), 0.0).when(has(STRING), text).when(has(ARRAY), common).when(has(BOOLEAN), 0.0).when(has(NUMBER), number).otherwise(common)


def _plain(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), "[^a-z0-9]", "")


def _named(o: Column, n: Column) -> Column:
    """0 to 1: likeness of two dotted names, mostly of their last parts."""
    leaf = lambda c: _plain(F.element_at(F.split(c, r"\."), -1))
    like = 1 - F.levenshtein(leaf(o), leaf(n)) / F.greatest(F.length(leaf(o)), F.length(leaf(n)), F.lit(1))
    above = lambda c: F.regexp_extract(c, r"^(.*)\.[^.]*$", 1)
    return 0.85 * like + F.when(above(o) == above(n), 0.15).otherwise(0.0)


#: Least evidence in values (and, for booleans, in names) for a rename.
CARRIED, BOOLEAN_NAME = 0.5, 0.8


def steps(fields: DataFrame, files: DataFrame) -> DataFrame:
    """(stream, file_seq, field, change, src, kinds): what begins, ends or changes type with each file.

    ``src`` is the file the field is in. A field's files are compared along one window per
    stream and field; files are numbered within their stream, so files without any field count.
    """
    order = Window.partitionBy("stream").orderBy("file_seq")
    near = files.distinct().select("stream", "file_seq", F.row_number().over(order).alias("nth"), F.lead("file_seq").over(order).alias("after"))
    along = Window.partitionBy("stream", "field").orderBy("nth")
    p = fields.join(near, ["stream", "file_seq"])
    p = p.select("stream", "file_seq", "field", "kinds", "nth", "after", F.lag("nth").over(along).alias("before"), F.lag("kinds").over(along).alias("was"), F.lead("nth").over(along).alias("next"))
    follows = F.coalesce(F.col("before") == F.col("nth") - 1, F.lit(False))
    goes_on = F.coalesce(F.col("next") == F.col("nth") + 1, F.lit(False))
    step = lambda change, at: F.struct(at.alias("file_seq"), F.lit(change).alias("change"), F.col("file_seq").alias("src"), "kinds")
    made = F.array_compact(F.array(
        F.when(~follows & (F.col("nth") > 1), step("added", F.col("file_seq"))),
        F.when(follows & (F.col("was") != F.col("kinds")), step("type_changed", F.col("file_seq"))),
        F.when(~goes_on & F.col("after").isNotNull(), step("removed", F.col("after"))),
    ))
    return p.select("stream", "field", F.inline(made)).select("stream", "file_seq", "field", "change", "src", "kinds")


def _best_first(pairs: Column) -> Column:
    """Of scored pairs, sorted, the ones whose both fields are still free. The pairs of one group
    are those of one file's ended and begun fields that carry values on."""
    none = F.array().cast("array<struct<old:string,field:string>>")
    free = lambda kept, x: ~F.exists(kept, lambda k: (k["old"] == x["old"]) | (k["field"] == x["field"]))
    return F.aggregate(F.array_sort(pairs), none, lambda kept, x: F.when(free(kept, x), F.array_append(kept, F.struct(x["old"].alias("old"), x["field"].alias("field")))).otherwise(kept))


def drift_report(ingested: DataFrame, target: dict[str, str] = TARGET) -> DataFrame:
    """(stream, file_seq, field, change, old): changes of ``ingest``'s files (keys stream and file_seq
    needed) against the previous file of their stream.

    The first file of a stream has no changes; a file without valid lines has no fields; late
    files take their place by file_seq; rows without a stream or file_seq belong to no file.
    ``ingested`` is read twice: give a written table.
    """
    at = ["stream", "file_seq"]
    files = ingested.select(*at).where("stream is not null and file_seq is not null")
    flat = written(steps(presence(ingested, target), files), "steps")
    ends = flat.where("kinds > 0 and change in ('added', 'removed')")
    both = ends.groupBy(*at, "kinds").agg(F.count(F.when(F.col("change") == "added", 1)).alias("a"), F.count(F.when(F.col("change") == "removed", 1)).alias("r")).where("a > 0 and r > 0").drop("a", "r")
    ends = ends.join(both, [*at, "kinds"], "left_semi")
    known = written(evidence(ingested, ends.select("stream", F.col("src").alias("file_seq"), "field"), target), "evidence").withColumnRenamed("file_seq", "src")
    told = ends.join(known, ["stream", "src", "field"])
    o, n = told.where("change = 'removed'").withColumnRenamed("field", "old").alias("o"), told.where("change = 'added'").alias("n")
    pairs = o.join(n, (F.col("o.stream") == F.col("n.stream")) & (F.col("o.file_seq") == F.col("n.file_seq")) & (F.col("o.kinds") == F.col("n.kinds")))
    name = _named(F.col("o.old"), F.col("n.field"))
    value = F.when(F.col("o.kinds") == BOOLEAN, F.when(name >= BOOLEAN_NAME, name).otherwise(0.0)).otherwise(_carried("o", "n", F.col("o.kinds")))
    scored = pairs.select("n.stream", "n.file_seq", "o.old", "n.field", name.alias("name"), value.alias("value")).where(F.col("value") >= CARRIED)
    best = scored.groupBy(*at).agg(_best_first(F.collect_list(F.struct((-(0.6 * F.col("value") + 0.4 * F.col("name"))).alias("cost"), "old", "field"))).alias("kept"))
    renamed = written(best.select(*at, F.inline("kept")), "renamed")
    come = renamed.select(*at, "field", F.lit("added").alias("change"), "old")
    gone = renamed.select(*at, F.col("old").alias("field"), F.lit("removed").alias("change"))
    out = flat.join(gone, [*at, "field", "change"], "left_anti").join(come, [*at, "field", "change"], "left")
    return out.select(*at, "field", F.when(F.col("old").isNotNull(), "renamed").otherwise(F.col("change")).alias("change"), "old")


def approved_renames(report: DataFrame, target: dict[str, str] = TARGET) -> DataFrame:
    """(stream, alias, target, from_seq, until_seq) of all reported renames that lead back to a target field.

    An alias holds from the file of its rename until the file in which its name is renamed
    away or begins anew. Chains are followed by pointer doubling over the renames.
    """
    ev = report.where("change = 'renamed'").select("stream", F.col("file_seq").alias("seq"), "old", "field")
    begins = ev.select("stream", F.col("field").alias("name"), "seq", F.lit(1).alias("begins"), "field")
    ends = ev.select("stream", F.col("old").alias("name"), "seq", F.lit(0).alias("begins"), "field")
    along = Window.partitionBy("stream", "name").orderBy("seq", "begins")
    history = begins.unionByName(ends).withColumns({"prev": F.lag(F.struct("seq", "begins")).over(along), "next": F.lead("seq").over(along)})
    spans = history.where("begins = 1").select("stream", "field", "seq", F.col("next").alias("until_seq"))
    ups = history.where("begins = 0 and prev.begins = 1").select("stream", "field", "seq", F.col("name").alias("up_field"), F.col("prev.seq").alias("up_seq"))
    state = written(ev.join(spans, ["stream", "field", "seq"]).join(ups, ["stream", "field", "seq"], "left").select("stream", "field", "seq", "until_seq", F.col("old").alias("origin"), "up_field", "up_seq"), "aliases")
    while not state.where("up_seq is not null").isEmpty():
        above = state.select("stream", F.col("field").alias("up_field"), F.col("seq").alias("up_seq"), F.col("origin").alias("o"), F.col("up_field").alias("f"), F.col("up_seq").alias("s"))
        state = written(state.join(above, ["stream", "up_field", "up_seq"], "left").select("stream", "field", "seq", "until_seq", F.coalesce("o", "origin").alias("origin"), F.col("f").alias("up_field"), F.col("s").alias("up_seq")), "aliases")
    known = list(target)
    return state.where(F.col("origin").isin(known) & ~F.col("field").isin(known)).select("stream", F.col("field").alias("alias"), F.col("origin").alias("target"), F.col("seq").alias("from_seq"), "until_seq")


def _replayed(text: Column, to: str) -> Column:
    """A rescued JSON text in the target's type, null where it doesn't fit."""
    inner = F.when(text.startswith('"'), _text_of(text))
    if to == "string":
        return inner
    if to == "boolean":
        word = F.coalesce(F.lower(inner), text)
        return F.when(word == "true", True).when(word == "false", False)
    number = F.when(text.rlike("^-?[0-9]"), text).when(inner.rlike(r"^-?[0-9]+(\.[0-9]+)?$"), inner)
    real = number.try_cast("double")
    if to == "double":
        return F.when(F.abs(real) < 1e308, real)
    return F.coalesce(number.try_cast("bigint"), F.when((F.abs(real) < 2.0**53) & (F.floor(real) == real), real.try_cast("bigint")))


def promote(ingested: DataFrame, approved: DataFrame, target: dict[str, str] = TARGET) -> DataFrame:
    """Replays rescued values into typed columns that are still null, where they cast: those of the
    field itself first, then those of its approved aliases in that file.

    Only what was replayed leaves ``rescued``: values that don't cast and values whose column
    is filled already stay there. Of several aliases of one column the first that casts is taken.
    ``approved`` without from_seq and until_seq holds for all files of a stream.
    """
    at = ["stream", "file_seq"]
    if "from_seq" in approved.columns:
        files = ingested.select(*at).where("stream is not null and file_seq is not null").distinct()
        approved = approved.join(files, "stream").where("file_seq >= from_seq and (until_seq is null or file_seq < until_seq)")
    else:
        at = ["stream"]
    per = approved.groupBy(*at).agg(F.map_from_entries(F.array_distinct(F.collect_list(F.struct("alias", "target")))).alias("_to"))
    df = ingested.join(per, at, "left")

    def took(n: str, t: str) -> Column:
        hits = F.filter(F.map_entries("rescued"), lambda e: (e["key"] == n) | F.coalesce(F.try_element_at(F.col("_to"), e["key"]) == n, F.lit(False)))
        fits = F.filter(F.transform(hits, lambda e: F.struct((e["key"] != n).alias("other"), e["key"].alias("k"), _replayed(e["value"], t).alias("v"))), lambda x: x["v"].isNotNull())
        return F.when(F.col(column_of(n)).isNull() & (F.size("rescued") > 0), F.coalesce(F.get(F.filter(fits, lambda x: ~x["other"]), F.lit(0)), F.get(fits, F.lit(0))))

    df = df.withColumn("_took", F.struct(*[took(n, t).alias(column_of(n)) for n, t in target.items()]))
    done = {c: F.coalesce(F.col(c), F.col(f"_took.{c}.v")) for c in map(column_of, target)}
    gone = F.array(*[F.col(f"_took.{column_of(n)}.k") for n in target])
    # array_contains is null, not false, where a null is in the array
    left = F.map_filter("rescued", lambda k, v: ~F.coalesce(F.array_contains(gone, k), F.lit(False)))
    return df.withColumns(done | {"rescued": left}).drop("_to", "_took")


def p6_found(spark, sf: str) -> DataFrame:
    lines = spark.read.parquet(f"{sf}/raw_lines.parquet")
    return drift_report(written(ingest(lines, ["stream", "file_seq"]), "ingested")).select("stream", "file_seq", "field", "change")


def p6_steps(spark, sf: str) -> DataFrame:
    """What begins, ends and changes type with each file, before renames are told from it."""
    lines = spark.read.parquet(f"{sf}/raw_lines.parquet")
    ingested = written(ingest(lines, ["stream", "file_seq"]), "ingested")
    files = ingested.select("stream", "file_seq").where("stream is not null and file_seq is not null")
    return steps(presence(ingested), files).select("stream", "file_seq", "field", "change")


def p6_table(spark, sf: str) -> DataFrame:
    """The consistent table: typed columns with renamed and retyped fields replayed, the rest as JSON."""
    lines = spark.read.parquet(f"{sf}/raw_lines.parquet")
    ingested = written(ingest(lines, ["line_id", "stream", "file_seq", "line_no"]), "ingested")
    table = promote(ingested, approved_renames(drift_report(ingested)))
    return table.select("line_id", "stream", "file_seq", "line_no", *[column_of(n) for n in TARGET], F.to_json("rescued").alias("rescued"), "unparsed", "valid")
