import json
import sqlite3

import pytest
from pyspark.sql import functions as F

from runloom.sources import files as S, traces as T

TRACES = {
    "a.jsonl": [{"session_id": "s1", "model": "m", "conversations": [{"from": "system", "value": "be kind"}, {"from": "human", "value": "hi"}, {"from": "gpt", "value": '<think>hm</think>sure <tool_call>{"name": "f", "arguments": {"x": 1}, "id": "c1"}</tool_call>'}, {"from": "tool", "value": '<tool_response>{"name": "f", "tool_call_id": "c1", "content": {"ok": true}}</tool_response>'}, {"from": "gpt", "value": "done"}]}],
    "b.jsonl": [{"hook": "pre_llm_call", "payload": {"session_id": "o1", "user_message": "go"}}, {"hook": "pre_tool_call", "payload": {"tool_name": "t", "args": {"a": 2}, "tool_call_id": "9"}}, {"hook": "unknown_hook", "payload": {}}, {"hook": "post_tool_call", "payload": {"tool_name": "t", "result": "fine", "status": "ok"}}, {"hook": "post_llm_call", "payload": {"assistant_response": "bye"}}, {"hook": "subagent_start", "payload": {"child_session_id": "o2", "child_goal": "dig"}}],
    "c.jsonl": [{"hook": "session_start", "payload": {"context": {"sessionId": "p1"}}}, {"hook": "before_tool_call", "payload": {"toolName": "k", "params": {"q": 1}}}, {"hook": "after_tool_call", "payload": {"toolName": "k", "error": "boom"}}, {"hook": "before_agent_reply", "payload": {"text": "reply"}}],
    "d.jsonl": [{"type": "system", "session_id": "z", "cwd": "/w"}, {"type": "user", "message": {"content": [{"type": "text", "text": "ask"}]}}, {"type": "assistant", "message": {"content": [{"type": "text", "text": "say"}, {"type": "tool_use", "id": "u1", "name": "g", "input": {"b": 1}}]}}, {"type": "tool_result", "tool_use_id": "u1", "content": "out", "is_error": True}, {"type": "result", "subtype": "success"}],
    "e.jsonl": [{"kind": "input", "session_id": "w", "payload_json": json.dumps({"text": "in"})}, {"kind": "tool_call", "session_id": "w", "payload_json": json.dumps({"name": "h", "args": {"c": 3}})}],
    "f.jsonl": [{"kind": "scope", "category": "tool", "scope_category": "start", "name": "n", "data": {"d": 4}, "metadata": {"session_id": "q"}}, {"kind": "scope", "category": "tool", "scope_category": "end", "name": "n", "data": "r"}],
    "g.jsonl": [{"session_id": "y", "steps": [{"tool_calls": [{"function_name": "v", "arguments": {"e": 5}}], "message": "m1", "observation": {"seen": 1}}, {"message": "m2"}]}],
    "h.jsonl": [{"schema_version": "x.trace.v1", "session": {"id": "nn"}, "events": [{"type": "user_message", "text": "t"}, {"type": "tool_call", "tool_name": "z", "args": {"f": 6}}]}],
}


@pytest.fixture(scope="module")
def events(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("traces")
    for name, rows in TRACES.items():
        (folder / name).write_text("\n".join(json.dumps(r) for r in rows) + "\nnot json\n")
    out = {}
    for r in T.read_traces(spark, str(folder)).collect():
        out.setdefault(r["trace_id"].rsplit("/", 1)[1], []).append(r)
    return {k: sorted(v, key=lambda r: r["event_index"]) for k, v in out.items()}


def kinds(events, name):
    return [r["event_type"] for r in events[name]]


def test_formats(events):
    assert kinds(events, "a.jsonl") == ["system_message", "user_message", "tool_call", "assistant_message", "tool_result", "assistant_message"]
    assert kinds(events, "b.jsonl") == ["user_message", "tool_call", "tool_result", "assistant_message", "subagent_start"]
    assert kinds(events, "c.jsonl") == ["session_start", "tool_call", "tool_result", "assistant_message"]
    assert kinds(events, "d.jsonl") == ["session_start", "user_message", "assistant_message", "tool_call", "tool_result", "session_end"]
    assert kinds(events, "e.jsonl") == ["user_message", "tool_call"]
    assert kinds(events, "f.jsonl") == ["tool_call", "tool_result"]
    assert kinds(events, "g.jsonl") == ["tool_call", "assistant_message", "tool_result", "assistant_message"]
    assert kinds(events, "h.jsonl") == ["user_message", "tool_call"]


def test_fields(events):
    call, said = events["a.jsonl"][2], events["a.jsonl"][3]
    assert (call["tool_name"], call["tool_call_id"], json.loads(call["args"]), call["status"], call["session_id"]) == ("f", "c1", {"x": 1}, "requested", "s1")
    assert said["text"] == "sure" and events["a.jsonl"][4]["text"] == '{"ok":true}'
    assert [r["session_id"] for r in events["b.jsonl"]] == ["o1", "o1", "o1", "o1", "o2"]
    assert (events["c.jsonl"][2]["status"], events["c.jsonl"][2]["text"]) == ("error", "boom")
    assert (events["d.jsonl"][4]["status"], events["d.jsonl"][4]["tool_call_id"], events["d.jsonl"][1]["text"]) == ("error", "u1", "ask")
    assert events["e.jsonl"][0]["text"] == "in" and json.loads(events["e.jsonl"][1]["args"]) == {"c": 3}
    assert json.loads(events["f.jsonl"][0]["args"]) == {"d": 4}
    assert [r["event_index"] for r in events["g.jsonl"]] == [0, 1, 2, 3]


def test_unknown_format_fails(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"what": 1}\n')
    with pytest.raises(Exception, match="unknown trace format"):
        T.read_traces(spark, str(tmp_path)).collect()


def test_ids(spark):
    rows = [("r", 0, "tool_call", "t", "1"), ("r", 1, "tool_result", "t", None), ("r", 2, "tool_call", "u", "2"), ("r", 3, "tool_call", "u", "3"), ("r", 4, "tool_result", "u", None), ("r", 5, "tool_result", "v", "9")]
    df = spark.createDataFrame(rows, "trace_id string, event_index long, event_type string, tool_name string, tool_call_id string")
    got = {r["event_index"]: (r["tool_call_id"], r["id_source"]) for r in T.infer_call_ids(df).collect()}
    assert got[1] == ("1", "inferred") and got[4] == (None, None)
    assert [(r["tool_call_id"], r["problem"]) for r in T.call_errors(df).collect()] == [("9", "orphan_result")]


def test_files(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.json").write_text('{"k": 1}')
    (tmp_path / "y.json").write_text('{"k": 2}')
    assert S.capture_files(spark, str(tmp_path)).count() == 2 and S.capture_files(spark, str(tmp_path), 1).count() == 1
    assert S.snapshot(spark, str(tmp_path / "y.json")).select(F.try_variant_get("state", "$.k", "int")).first()[0] == 2
    (tmp_path / "z.json").write_text("[1]")
    with pytest.raises(Exception, match="not a JSON object"):
        S.snapshot(spark, str(tmp_path / "z.json")).collect()


def test_sqlite(spark, tmp_path):
    path = tmp_path / "d.db"
    con = sqlite3.connect(path)
    con.execute("create table t as select 1 as a, 'x' as b union all select 2, null union all select 3, 'z'")
    con.commit()
    con.close()
    spark.dataSource.register(S.SqliteSource)
    read = lambda n: spark.read.format("runloom_sqlite").options(path=str(path), query="select * from t order by a", maxRows=str(n)).load().collect()
    assert [tuple(r) for r in read(0)] == [("1", "x", False), ("2", None, False), ("3", "z", False)]
    assert [r["truncated"] for r in read(2)] == [False, True]


def test_mail_and_objects(spark, tmp_path):
    (tmp_path / "m.eml").write_text("From: a@b\nTo: c@d\nSubject: hello\nMessage-ID: <1>\n\nbody text\n")
    row = S.mail(spark, str(tmp_path)).first()
    assert (row["sender"], row["subject"], row["body"].strip()) == ("a@b", "hello", "body text")
    df = spark.createDataFrame([('{"a": 1}',), ("{'b': None}",), ("[1]",), ("nope",), (None,)], "t string").select(S.object_text("t").alias("o"))
    assert [r["o"] for r in df.collect()] == ['{"a": 1}', '{"b": null}', "{}", "{}", "{}"]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "train"), (2, "test")], "i int, split string")
    S.write_splits(df, str(tmp_path / "out"))
    assert {p.name for p in (tmp_path / "out").iterdir() if p.is_dir()} == {"split=train", "split=test"}
    path = str(tmp_path / "t")
    mark = S.write_if_unchanged(df, path, None)
    with pytest.raises(RuntimeError, match="has changed"):
        S.write_if_unchanged(df.limit(1), path, "other")
    S.write_if_unchanged(df.limit(1), path, mark)
    assert spark.read.parquet(path).count() == 1


def test_runs_and_imports(spark, tmp_path):
    from runloom.sources import runs as R

    cards = spark.createDataFrame([("r1", "a", 90), ("r2", "b", 10), ("r3", "a", 50)], "run_id string, suite_id string, score int")
    events = spark.createDataFrame([("r1", 0), ("r1", 1), ("r2", 0)], "run_id string, event_index int")
    R.write_runs(cards, events, str(tmp_path / "runs"))
    assert [(r["run_id"], r["n_events"]) for r in R.read_runs(spark, str(tmp_path / "runs"), "a").collect()] == [("r1", 2)]
    results = spark.createDataFrame([("t1", "f", "x")], "task_id string, tool_name string, answer string")
    tasks = spark.createDataFrame([("t1", "fam"), ("t2", "held")], "task_id string, family string")
    tools = spark.createDataFrame([("f", "{}")], "tool_name string, tool_schema string")
    sealed = spark.createDataFrame([("held",)], "family string")
    assert R.import_conversations(results, tasks, tools, sealed).count() == 1
    for bad in (("t2", "f", "y"), ("t9", "f", "y"), ("t1", "g", "y")):
        more = results.unionAll(spark.createDataFrame([bad], results.schema))
        with pytest.raises(Exception, match="import refused"):
            R.import_conversations(more, tasks, tools, sealed).collect()
