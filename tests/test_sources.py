import json
import sqlite3

import pytest

from sessionloom.sources.registry import get_source, parse


def write(path, entries):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(e if isinstance(e, str) else json.dumps(e) for e in entries))


def test_trees_are_paired_and_stitched(spark, tmp_path):
    use = lambda i: {"type": "tool_use", "id": i, "name": "read_file", "input": {"path": "a.py", "_x": None}}
    write(tmp_path / "p/a.jsonl", [
        {"type": "user", "uuid": "u1", "sessionId": "A", "timestamp": "1", "cwd": "/w", "message": {"role": "user", "content": "start"}}, "", "not json",
        {"type": "assistant", "uuid": "u2", "parentUuid": "u1", "timestamp": "2", "message": {"model": "m", "content": [{"type": "text", "text": "hm"}, {"type": "thinking", "thinking": "t1"}, use("c1"), use("c2")]}},
        {"type": "user", "uuid": "u3", "parentUuid": "u2", "timestamp": "3", "message": {"content": [{"type": "tool_result", "tool_use_id": "c2", "content": [{"type": "text", "text": "r2"}]}, {"type": "tool_result", "tool_use_id": "c1", "content": "r1", "is_error": True}]}},
        {"type": "user", "uuid": "u4", "isMeta": True, "message": {"content": "meta"}},
    ])
    write(tmp_path / "p/b.jsonl", [{"type": "user", "uuid": "v1", "parentUuid": "u3", "sessionId": "B", "timestamp": "4", "message": {"content": "again"}}, {"type": "assistant", "uuid": "v2", "timestamp": "5", "message": {"content": [{"type": "text", "text": "ok"}]}}])
    write(tmp_path / "p/A/subagents/agent-1.jsonl", [{"type": "user", "sessionId": "A", "message": {"content": "sub"}}, {"type": "assistant", "message": {"content": [{"type": "text", "text": "did"}]}}])
    rows = {r.id: r for r in parse(spark, "claude", str(tmp_path)).collect()}
    assert set(rows) == {"A", "A::agent-1"}
    a = rows["A"]
    assert [(m.role, m.content) for m in a.messages] == [("user", "start"), ("assistant", "<think>t1</think>\nhm"), ("tool", "r1"), ("tool", "r2"), ("user", "again"), ("assistant", "ok")]
    assert a.messages[2].is_error and a.metadata.resumed_from == ["B"] and a.metadata.end_time == "5" and a.metadata.model == "m"
    assert a.tools[0].function.parameters.required == ["path"] and rows["A::agent-1"].metadata.is_subagent


def test_chats(spark, tmp_path):
    write(tmp_path / "w/chats/s 1.jsonl", [
        {"uuid": "2", "type": "assistant", "timestamp": "t2", "message": {"parts": [{"text": "<think>a</think>b"}, {"functionCall": {"name": "ls", "args": {"d": 1}}}]}},
        {"uuid": "1", "type": "user", "timestamp": "t1", "message": {"parts": [{"text": "hi"}, {"text": "--- Content from referenced files --- x"}]}},
        {"uuid": "1", "type": "user", "timestamp": "t9", "message": {"parts": [{"text": "again"}]}},
        {"uuid": "3", "type": "tool_result", "timestamp": "t3", "toolCallResult": {"callId": "call_0"}, "message": {"parts": [{"functionResponse": {"name": "ls", "response": {"output": "o", "error": "e"}}}]}},
    ])
    r = parse(spark, "qwen", str(tmp_path)).first()
    assert r.id == "s 1" and [(m.role, m.content) for m in r.messages] == [("user", "hi"), ("assistant", "<think>\na\n</think>\nb"), ("tool", "o\nError: e")]
    assert r.messages[1].tool_calls[0].id == "call_0" and r.metadata.start_time == "t1"


def test_store(spark, tmp_path):
    db = sqlite3.connect(tmp_path / "opencode.db")
    db.executescript("create table session(id, directory, time_created, time_updated); create table message(id, session_id, data, time_created); create table part(message_id, data, time_created)")
    db.execute("insert into session values('s', '/d', 1, 2)")
    db.executemany("insert into message values(?, 's', ?, ?)", [("m1", '{"role": "user"}', 1), ("m2", '{"role": "assistant", "model": {"modelID": "gpt-4"}}', 2)])
    db.executemany("insert into part values(?, ?, ?)", [("m1", '{"type": "text", "text": "q"}', 1), ("m2", '{"type": "text", "text": "a"}', 1), ("m2", '{"type": "reasoning", "text": "r"}', 2), ("m2", '{"type": "tool", "tool": "ls", "state": {"input": {}, "status": "error", "output": "x"}}', 3)])
    db.commit()
    r = parse(spark, "opencode", str(tmp_path)).first()
    assert [(m.role, m.content) for m in r.messages] == [("user", "q"), ("assistant", "<think>r</think>\na"), ("tool", "x")] and r.messages[2].is_error and r.metadata.model == "gpt-4"


def test_missing_and_unknown(spark, tmp_path):
    assert parse(spark, "all", str(tmp_path / "none")).count() == 0
    with pytest.raises(ValueError):
        get_source("nope")
