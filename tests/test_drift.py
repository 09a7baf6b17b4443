import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sessionloom.operators import drift as D


def rows(spark):
    f = []
    for i in range(8):
        f.append(("s", 0, i, json.dumps({"version": f"1.0.{i % 2}", "uuid": f"{i:08x}-0000-7000-8000-00000000000{i}", "n": i, "gone": "x y"})))
        f.append(("s", 1, i, json.dumps({"app": {"version": f"1.0.{i % 2}"}, "uuid": f"{i + 9:08x}-0000-7000-8000-00000000000{i}", "n": str(i), "level": ["info", "warn"][i % 2]})))
    f += [("s", 1, 9, None), ("s", 1, 10, ""), ("s", 1, 11, '{"cut": '), ("s", 1, 12, "[1]")]
    return spark.createDataFrame(f, "stream string, file_seq int, line_id int, line string")


def test_report(spark):
    got = {(r.file_seq, r.field, r.change) for r in D.drift_report(D.ingest(rows(spark), ["stream", "file_seq"])).collect()}
    assert got == {(1, "app", "added"), (1, "app.version", "renamed"), (1, "level", "added"), (1, "gone", "removed"), (1, "n", "type_changed")}


def test_rescue_and_promote(spark):
    ingested = D.ingest(rows(spark), ["stream", "file_seq", "line_id"])
    table = D.promote(ingested, D.approved_renames(D.drift_report(ingested)))
    late = [r for r in table.collect() if r.file_seq == 1]
    assert sum(r.valid for r in late) == 9 and len(late) == 12
    assert {r.version for r in late if r.line_id < 8} == {"1.0.0", "1.0.1"}
    assert all("app.version" not in (r.rescued or {}) for r in late)
    assert D.drift_report(ingested.limit(0)).count() == 0


def test_promote_keeps_what_it_does_not_replay(spark):
    lines = [
        {"body": [{"type": "text"}], "runs": "12"},
        {"body": 7, "runs": 1.5},
        {"body": "said \"x\"", "runs": 3.0},
        {"message": {"content": "own"}, "body": "other", "runs": "many"},
        {"message": {"content": ["a"]}, "body": {}, "text": "later", "flag": 1, "extra": {}},
        {"body": "one", "text": "two", "flag": "TRUE"},
    ]
    df = spark.createDataFrame([("s", i, json.dumps(x)) for i, x in enumerate(lines)] + [("t", 6, json.dumps(lines[0]))], "stream string, i int, line string")
    approved = spark.createDataFrame([("s", "body", "message.content"), ("s", "text", "message.content"), ("s", "runs", "durationMs"), ("s", "flag", "isMeta")], "stream string, alias string, target string")
    got = [(r.message_content, r.durationMs, r.isMeta, {k: json.loads(v) for k, v in r.rescued.items()}) for r in D.promote(D.ingest(df, ["stream", "i"]), approved).orderBy("i").collect()]
    assert got == [
        (None, 12, None, {"body": [{"type": "text"}]}),
        (None, None, None, {"body": 7, "runs": 1.5}),
        ('said "x"', 3, None, {}),
        ("own", None, None, {"body": "other", "runs": "many"}),
        ("later", None, None, {"message.content": ["a"], "body": {}, "flag": 1, "extra": {}}),
        ("one", None, True, {"text": "two"}),
        (None, None, None, {"body": [{"type": "text"}], "runs": "12"}),
    ]


def test_a_rename_followed_by_a_retype_loses_nothing(spark):
    told = [f"{w} went to the {w} place again and again today" for w in ("ann", "bob", "cid", "dan", "eve", "fay")]
    f = [("s", 0, i, json.dumps({"message": {"content": x}})) for i, x in enumerate(told)]
    f += [("s", 1, i, json.dumps({"body": x})) for i, x in enumerate(told)]
    f += [("s", 2, i, json.dumps({"body": [{"text": x}]})) for i, x in enumerate(told)]
    ingested = D.ingest(spark.createDataFrame(f, "stream string, file_seq int, line_id int, line string"), ["stream", "file_seq", "line_id"])
    table = {(r.file_seq, r.line_id): (r.message_content, r.rescued) for r in D.promote(ingested, D.approved_renames(D.drift_report(ingested))).collect()}
    assert all(table[1, i] == (x, {}) for i, x in enumerate(told))
    assert all(table[2, i][0] is None and json.loads(table[2, i][1]["body"]) == [{"text": x}] for i, x in enumerate(told))


def test_a_stream_whose_renames_reach_no_target(spark):
    report = spark.createDataFrame([("s", 1, "note", "renamed", "memo"), ("t", 1, "body", "renamed", "message.content")], "stream string, file_seq int, field string, change string, old string")
    assert [tuple(r) for r in D.approved_renames(report).collect()] == [("t", "body", "message.content", 1, None)]


def test_aliases_hold_for_their_files(spark):
    steps = [("s", 2, "body", "renamed", "message.content"), ("s", 4, "text", "renamed", "body"), ("s", 6, "message.content", "renamed", "text"), ("s", 7, "note", "renamed", "message.content"), ("s", 5, "memo", "renamed", "label")]
    report = spark.createDataFrame(steps, "stream string, file_seq int, field string, change string, old string")
    got = sorted(tuple(r) for r in D.approved_renames(report).collect())
    assert got == [("s", "body", "message.content", 2, 4), ("s", "note", "message.content", 7, None), ("s", "text", "message.content", 4, 6)]
    lines = [("s", seq, json.dumps({"body": f"b{seq}", "text": f"t{seq}"})) for seq in range(1, 8)] + [("u", 3, '{"body": "other"}'), (None, 3, '{"body": "none"}')]
    table = D.promote(D.ingest(spark.createDataFrame(lines, "stream string, file_seq int, line string"), ["stream", "file_seq"]), D.approved_renames(report))
    found = {(r.stream, r.file_seq): r.message_content for r in table.collect()}
    assert found == {("s", 1): None, ("s", 2): "b2", ("s", 3): "b3", ("s", 4): "t4", ("s", 5): "t5", ("s", 6): None, ("s", 7): None, ("u", 3): None, (None, 3): None}


def leaves(o, prefix=""):
    """Dotted names and values of what isn't a filled object."""
    for k, v in o.items():
        if isinstance(v, dict) and v:
            yield from leaves(v, f"{prefix}{k}.")
        else:
            yield prefix + k, v


values = st.recursive(st.none() | st.booleans() | st.integers(-(2**70), 2**70) | st.floats(allow_nan=False) | st.text(max_size=6), lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text(max_size=4), x, max_size=3), max_leaves=8)
objects = st.dictionaries(st.sampled_from(sorted({n.partition(".")[0] for n in D.TARGET})) | st.text(max_size=4), values, max_size=6)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(docs=st.lists(objects, min_size=1, max_size=30))
def test_no_leaf_is_lost(spark, docs):
    texts = [json.dumps(d, ensure_ascii=i % 2 == 0) for i, d in enumerate(docs)]
    odd = [None, "", "  ", "[1, 2]", '"x"', "12", '{"cut": ', '{"a": 1, "a": 2}', '{"a": {"b": 1}, "a.b": 2}', '{"k": "\\ud800"}', '{"\\ud800": 1}', '{"version": "\\udc00", "n": {"a": 1, "a": 1}}', "{}", "nul", "9" * 5000]
    rows = [(i, t, "clash") for i, t in enumerate(texts + odd)]
    out = {r.i: r for r in D.ingest(spark.createDataFrame(rows, "i int, line string, rescued string"), ["i"]).collect()}
    assert len(out) == len(rows)
    for i, t, _ in rows:
        r = out[i].asDict()
        if r["unparsed"] is not None or t is None:
            assert r["unparsed"] == t
            continue
        told = {n: r[D.column_of(n)] for n in D.TARGET if r[D.column_of(n)] is not None} | {k: json.loads(v) for k, v in r["rescued"].items()}
        assert told == dict(leaves(json.loads(t))) and r["valid"]
    assert [out[len(texts) + k].valid for k in range(len(odd))] == [False, False, False, True, True, True, False, True, True, True, True, True, True, False, False]
