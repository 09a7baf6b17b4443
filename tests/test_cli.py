import json
import sqlite3

import pytest

from sessionloom import cli
from sessionloom.operators.redact import WORDLIST_VARIABLE, scan_text
from sessionloom.schema import CONVERSATION
from sessionloom.sources import files, registry
from sessionloom.streaming import stages as streaming
from tests.test_sources import write


def records(folder):
    return [json.loads(x) for f in sorted(folder.glob("part-*")) for x in f.read_text().splitlines()]


@pytest.fixture
def logs(tmp_path):
    use = {"type": "tool_use", "id": "c1", "name": "bash", "input": {"cmd": "cat x", "n": 1.50}}
    said = lambda t: {"type": "user", "uuid": f"u{t}", "sessionId": f"S{t}", "timestamp": f"{t}", "message": {"content": "words " * 2000 + "sk-ant-" + "aB3dE6gH9j" * 4}}
    answer = {"type": "user", "timestamp": "8", "message": {"content": [{"type": "tool_result", "tool_use_id": "c1", "content": "Exit Code: 127"}]}}
    write(tmp_path / "logs/p/b.jsonl", [said(2), {"type": "assistant", "timestamp": "7", "message": {"content": [{"type": "text", "text": "ok"}, use]}}, answer])
    write(tmp_path / "logs/p/a.jsonl", [said(3), {"type": "assistant", "timestamp": "9", "message": {"content": [{"type": "text", "text": "fine"}]}}])
    (tmp_path / "logs/p/bad.jsonl").write_bytes(b'{"type": "user"}\n\xff\xfe\n')
    return tmp_path


def test_run_tells_what_it_did(spark, logs, capsys):
    (logs / "prompts").mkdir()
    (logs / "prompts/claude.md").write_text("be brief")
    assert cli.main(["run", "--source", "claude", "--input", str(logs / "logs"), "--output", str(logs / "out"), "--prompts", str(logs / "prompts"), "--min-score", "0.1"], spark) == 0
    told = capsys.readouterr()
    assert "Redacted 2 secrets" in told.out and "Total tool results removed: 1" in told.out and "Good: 0  Maybe: 0  Bad: 2" in told.out and "Filtered 2 -> 2 records" in told.out
    assert "bad.jsonl: not UTF-8" in told.err
    raw = records(logs / "out_raw.jsonl")
    assert [r["id"] for r in raw] == ["S2", "S3"] and all(r["messages"][0] == {"role": "system", "content": "be brief"} for r in raw)
    final = records(logs / "out.jsonl")
    assert len(final) == 2 and all("[REDACTED_ANTHROPIC_API_KEY]" in "".join(r["messages"]) for r in final)


def test_stages_one_by_one(spark, logs, capsys):
    at = lambda n: str(logs / n)
    own = logs / "mine.md"
    own.write_text("my own")
    assert cli.main(["parse", "--source", "claude", "--input", at("logs"), "--output", at("a"), "--user-prompt", f"claude={own}"], spark) == 0
    assert cli.main(["redact", "--input", at("a.jsonl"), "--output", at("b")], spark) == 0
    assert cli.main(["clean", "--input", at("b.jsonl"), "--output", at("c")], spark) == 0
    assert cli.main(["evaluate", "--input", at("c.jsonl"), "--output", at("d"), "--min-token-count", "10"], spark) == 0
    assert cli.main(["filter", "--input", at("d.jsonl"), "--output", at("e"), "--min-score", "0.39"], spark) == 0
    told = capsys.readouterr().out
    assert "Parsed 2 sessions" in told and "Redacted 2 secrets" in told and "Loaded 2 conversations" in told and "Bad: 2" in told and "Filtered 2 -> " in told
    assert records(logs / "a.jsonl")[0]["messages"][0]["content"] == "my own"

    def counter():
        def count(messages, tools):
            if any(m["role"] == "assistant" and m.get("content") == "fine" for m in messages):
                raise ValueError("no template")
            return len(messages)

        return count

    assert cli.main(["validate", "--input", at("b.jsonl"), "--output", at("v")], spark, counter) == 0
    told = capsys.readouterr().out
    assert "Passed: 1" in told and "Failed: 1" in told and "[S3] ValueError: no template" in told and "Sessions with tools: 1" in told
    (passed,) = records(logs / "v.jsonl")
    assert passed["id"] == "S2" and passed["source"] == "claude" and "tokens" not in passed
    assert cli.main(["validate"], spark) == 1


def test_upload(monkeypatch, tmp_path, capsys):
    calls = []

    class Api:
        def __getattr__(self, name):
            return lambda **k: calls.append((name, k.get("path_in_repo") or k.get("private")))

    for v in cli.TOKEN_VARIABLES:
        monkeypatch.delenv(v, raising=False)
    assert not cli.upload(str(tmp_path), "me/x", api=Api()) and not calls
    monkeypatch.setenv(cli.TOKEN_VARIABLES[2], "t")
    assert cli.upload(str(tmp_path), "me/x", True, Api()) and calls == [("create_repo", True), ("upload_file", "README.md"), ("upload_folder", "data")]
    assert "me/x" in cli.dataset_card("f.jsonl", "me/x")


def test_lines_and_kinds(spark, tmp_path):
    write(tmp_path / "p/a.jsonl", [
        '\t{"type": "user", "uuid": "1", "uuid": "2", "message": {"content": "[1, 2]"}} ', "[]", '{"type": "user"} x',
        {"type": "assistant", "message": {"content": [{"type": "tool_use", "id": "c", "name": "f", "input": {}}, {"type": "tool_use", "id": "d", "name": "f", "input": {}}, "plain"]}},
        {"type": "user", "message": {"content": [{"type": "tool_result", "tool_use_id": "c", "content": '["a", "b"]'}, {"type": "tool_result", "tool_use_id": "d", "content": ["a", {"type": "text", "text": "b"}]}]}},
    ])
    (row,) = registry.parse(spark, "claude", str(tmp_path)).collect()
    assert [(m.role, m.content) for m in row.messages] == [("user", "[1, 2]"), ("assistant", ""), ("tool", '["a", "b"]'), ("tool", "a\nb")]
    many = tmp_path / "many.jsonl"
    many.write_text("\r\n".join(json.dumps({"id": None, "source": str(i)}) for i in range(3000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        got = files.read_jsonl(spark, str(many), CONVERSATION).select("id", "source").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {r.source: r.id for r in got} == {str(i): str(i) for i in range(3000)}


def test_store_order_is_by_number(spark, tmp_path):
    db = sqlite3.connect(tmp_path / "opencode.db")
    db.executescript("create table session(id, directory, time_created, time_updated); create table message(id, session_id, data, time_created); create table part(message_id, data, time_created)")
    db.execute("insert into session values('s', '/d', 1, 2)")
    times = [10, 9, None, "8", -3, 2.5]
    db.executemany("insert into message values(?, 's', '{\"role\": \"user\"}', ?)", [(f"m{t}", t) for t in times])
    db.executemany("insert into part values(?, ?, 1)", [(f"m{t}", json.dumps({"type": "text", "text": str(t)})) for t in times])
    db.commit()
    want = [r[0][1:] for r in db.execute("select id from message order by time_created, rowid")]
    (row,) = registry.parse(spark, "opencode", str(tmp_path)).collect()
    assert [m.content for m in row.messages] == want == ["None", "-3", "2.5", "9", "10", "8"]


def test_mnemonics_by_word_list(tmp_path, monkeypatch):
    words = tmp_path / "words.txt"
    words.write_text("\n".join(f"{a}bc{b}" for a in "klmnop" for b in "xyzuvw"))
    listed = words.read_text().split()
    phrase = " ".join(listed[:12])
    assert not scan_text(f"seed: {phrase}")
    monkeypatch.setenv(WORDLIST_VARIABLE, str(words))
    assert [(f.pattern_name, f.start, f.end) for f in scan_text(f"seed: {phrase}")] == [("bip39_mnemonic", 6, 6 + len(phrase))]
    assert len(scan_text(" ".join(listed[:24]))) == 1 and not scan_text(" ".join(listed[:13])) and not scan_text(phrase.replace(" ", ", "))


def test_stream(spark, tmp_path):
    text = "words " * 4000
    for i in range(2):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / f"in/{i}.json").write_text(json.dumps({"id": str(i), "source": "x", "messages": [{"role": "user", "content": text}, {"role": "assistant", "content": "a" if i else None}]}))
    scored = streaming.score_stream(streaming.read_records(spark, str(tmp_path / "in")), min_score=0.2)
    streaming.write_stream(scored, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    got = spark.read.json(str(tmp_path / "out")).collect()
    assert [r.id for r in got] == ["1"]  # the other one has a single message left
