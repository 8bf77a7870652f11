import json

from pyspark.sql import functions as F

from runloom.sources import traces as T
from runloom.streaming import observer as O

ROWS = [
    {"hook": "pre_llm_call", "captured_at": "2024-01-01T10:00:00Z", "payload": {"session_id": "s", "user_message": "password=hunter2 please"}},
    {"hook": "pre_tool_call", "captured_at": "2024-01-01T10:01:00Z", "payload": {"session_id": "s", "tool_name": "t", "args": {"a": 1}}},
    {"hook": "post_tool_call", "captured_at": "2024-01-01T12:00:00Z", "payload": {"session_id": "s", "tool_name": "t", "result": "ok"}},
    {"hook": "nothing", "payload": {}},
]


def folder(tmp_path):
    (tmp_path / "log").mkdir()
    for i, r in enumerate(ROWS):
        (tmp_path / "log" / f"{i}.jsonl").write_text(json.dumps(r) + "\n")
    return str(tmp_path / "log")


def test_stream_equals_batch_and_redacts(spark, tmp_path):
    path = folder(tmp_path)
    got = O.drain(O.observer_stream(spark, path)).select("event_type", "tool_name", "status", "text").collect()
    want = T.read_traces(spark, path, "observer").select("event_type", "tool_name", "status", "text").collect()
    assert {r["event_type"] for r in got} == {r["event_type"] for r in want} == {"user_message", "tool_call", "tool_result"}
    assert [r["text"] for r in got if r["event_type"] == "user_message"] == ["password=[REDACTED]"]
    assert sorted((r["event_type"], r["tool_name"] or "", r["status"] or "") for r in got) == sorted((r["event_type"], r["tool_name"] or "", r["status"] or "") for r in want)


def test_long_texts_are_redacted_before_the_cut(spark, tmp_path):
    secret = 'password="hunter two three"'
    text = "x " * 9_994 + secret + " y" * 50
    (tmp_path / "0.jsonl").write_text(json.dumps({**ROWS[0], "payload": {"session_id": "s", "user_message": text}}) + "\n")
    got = [r["text"] for r in O.drain(O.observer_stream(spark, str(tmp_path))).collect()]
    assert len(got) == 1 and got[0].endswith("...[truncated]") and len(got[0]) == O.MAX_TEXT + 14
    assert "hu" not in got[0]


def test_windows_and_sessions(spark, tmp_path):
    stream = O.observer_stream(spark, folder(tmp_path))
    counts = O.drain(O.windowed_counts(stream, "ts", "event_type", "1 hour", "1 day", "30 minutes"), "complete")
    assert counts.agg(F.sum("n")).first()[0] == 6  # each event is in two sliding windows
    sessions = O.drain(O.session_counts(O.observer_stream(spark, str(tmp_path / "log")), "ts", "session_id", "30 minutes"), "complete")
    assert sorted(r["n"] for r in sessions.collect()) == [1, 2]
