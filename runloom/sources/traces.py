"""Readers of agent trace files: seven formats to one event table.

Every reader is a projection over lines parsed as VARIANT; nothing is collected,
and a directory of files of mixed formats is read in one pass, each file by the
format of its first JSON object. Lines keep their order by the file block they
come from and their place in it. Events:

``trace_id, event_index, session_id, event_type, tool_name, tool_call_id, status, text, args``
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from runloom.functions.predicates import members

FORMATS = ("normalized", "trajectory", "observer", "plugin", "stream", "scope", "steps")
# Hook names and event kinds of the formats.
OBSERVER_HOOKS = ("pre_tool_call", "post_tool_call", "pre_llm_call", "post_llm_call", "pre_api_request", "post_api_request", "api_request_error", "pre_approval_request", "post_approval_response", "subagent_start", "subagent_stop", "on_session_start", "on_session_end", "on_session_finalize", "on_session_reset")
PLUGIN_HOOKS = {
    "agent_end": "agent_end", "agent_turn_prepare": "agent_turn_prepare", "after_tool_call": "tool_result", "before_agent_finalize": "before_agent_finalize", "before_agent_reply": "assistant_message",
    "before_agent_run": "user_message", "before_agent_start": "user_message", "before_model_resolve": "before_model_resolve", "before_prompt_build": "user_message", "before_tool_call": "tool_call",
    "llm_input": "llm_input", "llm_output": "assistant_message", "model_call_ended": "api_call", "model_call_started": "api_call", "session_end": "session_end", "session_start": "session_start",
    "subagent_ended": "subagent_stop", "subagent_spawned": "subagent_start", "subagent_spawning": "subagent_start",
}
STREAM_TYPES = {"system": "session_start", "user": "user_message", "assistant": "assistant_message", "tool_result": "tool_result", "result": "session_end"}
DAEMON_KINDS = {"error": "error", "exit": "session_end", "input": "user_message", "kill": "session_end", "metadata": "metadata", "output": "assistant_message", "patch_metadata": "metadata", "tool_call": "tool_call", "tool_result": "tool_result"}
TOOL_CALL, TOOL_RESPONSE = r"(?s)<tool_call>\s*(.*?)\s*</tool_call>", r"(?s)<tool_response>\s*(.*?)\s*</tool_response>"

EVENT = "struct<event_type:string,session_id:string,tool_name:string,tool_call_id:string,status:string,text:string,args:string>"


def get(v: Column, *paths: str) -> Column:
    """Text of the first path that is there and not null."""
    return F.coalesce(*[F.try_variant_get(v, f"$.{p}", "string") for p in paths])


def sub(v: Column, path: str) -> Column:
    return F.try_variant_get(v, f"$.{path}", "variant")


def mapped(name: Column, table: dict[str, str]) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for p in table.items() for x in p]), name)


def event(kind: Column | str, session: Column, tool: Column | None = None, call: Column | None = None, status: Column | str | None = None, text: Column | None = None, args: Column | None = None) -> Column:
    null = F.lit(None).cast("string")
    lit = lambda x: null if x is None else F.lit(x) if isinstance(x, str) else x
    return F.struct(
        lit(kind).alias("event_type"), session.alias("session_id"), lit(tool).alias("tool_name"), lit(call).alias("tool_call_id"), lit(status).alias("status"), F.coalesce(lit(text), F.lit("")).alias("text"), lit(args).alias("args")
    ).cast(EVENT)


def objects(v: Column) -> Column:
    """JSON of an object, for arguments; null for anything else."""
    return F.when(F.schema_of_variant(v).startswith("OBJECT"), F.to_json(v))


def lines(spark: SparkSession, path: str) -> DataFrame:
    """``(trace_id, block, line, v)``: each line that is JSON, in file order by (block, line)."""
    raw = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("trace_id"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    return raw.select("trace_id", "block", "line", F.try_parse_json("value").alias("v")).filter("v is not null")


def hook(v: Column) -> Column:
    return get(v, "hook", "event", "name")


def format_of(v: Column) -> Column:
    """Format that a file's first object tells."""
    schema = F.coalesce(get(v, "schema_version"), F.lit(""))
    has = lambda p: sub(v, p).isNotNull()
    return (
        F.when(schema.rlike("trace\\.v1$") & has("events"), "normalized")
        .when(get(v, "type").isin(*STREAM_TYPES), "stream")
        .when(get(v, "kind").isin(*DAEMON_KINDS) & (has("payload_json") | has("payload")), "stream")
        .when(has("conversations"), "trajectory")
        .when(schema.startswith("ATIF") | has("steps"), "steps")
        .when(hook(v).isin(*PLUGIN_HOOKS), "plugin")
        .when(hook(v).isin(*OBSERVER_HOOKS), "observer")
        .when(get(v, "kind").isin("scope", "mark"), "scope")
    )


def _trajectory(v: Column) -> Column:
    session = get(v, "session_id")

    def turn(t: Column) -> Column:
        role, value = get(t, "from"), F.coalesce(json_plain(sub(t, "value")), F.lit(""))
        calls = F.transform(F.regexp_extract_all(value, F.lit(TOOL_CALL), F.lit(1)), lambda x: F.try_parse_json(x))
        answers = F.transform(F.regexp_extract_all(value, F.lit(TOOL_RESPONSE), F.lit(1)), lambda x: F.try_parse_json(x))
        clean = F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "(?s)<think>.*?</think>", ""), TOOL_CALL, ""), TOOL_RESPONSE, ""))
        none = F.array().cast(f"array<{EVENT}>")
        asked = F.transform(F.filter(calls, lambda c: c.isNotNull()), lambda c: event("tool_call", session, F.coalesce(get(c, "name"), F.lit("unknown")), get(c, "tool_call_id", "id"), "requested", None, F.coalesce(objects(sub(c, "arguments")), F.lit("{}"))))
        given = F.transform(F.filter(answers, lambda c: c.isNotNull()), lambda c: event("tool_result", session, F.coalesce(get(c, "name"), F.lit("unknown")), get(c, "tool_call_id"), "ok", json_plain(sub(c, "content"))))
        said = F.when(clean != "", F.array(event("assistant_message", session, text=clean))).otherwise(none)
        plain = mapped(role, {"human": "user_message", "system": "system_message", "developer": "developer_message"})
        return F.when(role == "gpt", F.concat(asked, said)).when(role == "tool", given).when(plain.isNotNull(), F.array(event(plain, session, text=value))).otherwise(none)

    return F.flatten(F.transform(members(sub(v, "conversations")), turn))


def json_plain(v: Column) -> Column:
    """A string as it is, null as null, anything else as compact JSON."""
    return F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string")).when(~F.is_variant_null(v), F.to_json(v))


def _observer(v: Column) -> Column:
    p = F.coalesce(F.when(F.schema_of_variant(sub(v, "payload")).startswith("OBJECT"), sub(v, "payload")), v)
    h, session = hook(v), get(p, "session_id", "parent_session_id")
    tool, call = F.coalesce(get(p, "tool_name"), F.lit("unknown")), get(p, "tool_call_id")
    said = get(p, "assistant_response", "output")
    one = (
        F.when(h == "pre_tool_call", event("tool_call", session, tool, call, "requested", None, F.coalesce(objects(sub(p, "args")), F.lit("{}"))))
        .when(h == "post_tool_call", event("tool_result", session, tool, call, F.coalesce(get(p, "status"), F.lit("unknown")), F.coalesce(json_plain(sub(p, "result")), get(p, "error_message"))))
        .when(h == "post_llm_call", event("assistant_message", session, text=said))
        .when(h == "pre_llm_call", event("user_message", session, text=get(p, "user_message")))
        .when(h.isin("subagent_start", "subagent_stop"), event(h, F.coalesce(get(p, "child_session_id"), session), text=get(p, "child_goal")))
        .when(h.isin("pre_approval_request", "post_approval_response"), event("approval", session, status=get(p, "choice"), text=F.to_json(p)))
        .when(h.isin("pre_api_request", "post_api_request", "api_request_error"), event("api_call", session, status=get(p, "status_code", "finish_reason"), text=h))
    )
    return F.when(one.isNotNull(), F.array(one))


def _plugin(v: Column) -> Column:
    p = F.coalesce(F.when(F.schema_of_variant(sub(v, "payload")).startswith("OBJECT"), sub(v, "payload")), v)
    h = hook(v)
    keys = ("sessionId", "session_id", "sessionKey", "session_key", "runId", "run_id")
    session = F.coalesce(*[get(p, k) for k in keys], *[get(p, f"context.{k}") for k in keys], *[get(p, f"ctx.{k}") for k in keys], *[get(v, k) for k in keys])
    tool, call = get(p, "toolName", "tool_name", "tool.name", "name"), get(p, "toolCallId", "tool_call_id", "callId", "call_id")
    args = F.coalesce(*[objects(sub(p, k)) for k in ("params", "args", "arguments", "input")])
    messages = members(sub(p, "messages"))
    last = F.try_element_at(F.filter(messages, lambda m: get(m, "role") == "user"), F.lit(-1))
    text = F.coalesce(get(p, "prompt", "text", "input", "content", "output", "reply"), get(last, "content"))
    result = F.coalesce(*[json_plain(sub(p, k)) for k in ("result", "output", "error")])
    kind = F.coalesce(mapped(h, PLUGIN_HOOKS), h)
    status = F.when(kind == "tool_call", "requested").otherwise(F.coalesce(get(p, "status", "reason", "outcome"), F.when(kind == "tool_result", F.when(sub(p, "error").isNotNull(), "error").otherwise("ok"))))
    one = event(kind, session, F.when(kind.isin("tool_call", "tool_result"), F.coalesce(tool, F.lit("unknown"))), call, status, F.when(kind == "tool_result", result).when(kind == "api_call", h).otherwise(text), args)
    return F.when(h.isNotNull(), F.array(one))


def _stream(v: Column) -> Column:
    session, kind, mode = get(v, "session_id"), get(v, "type"), get(v, "kind")
    blocks = members(sub(v, "message.content"))
    spoken = F.coalesce(get(v, "message.content"), F.array_join(F.transform(F.filter(blocks, lambda b: get(b, "type") == "text"), lambda b: get(b, "text")), "\n"))
    spoken = F.when(F.schema_of_variant(sub(v, "message.content")).startswith("ARRAY"), F.array_join(F.transform(F.filter(blocks, lambda b: get(b, "type") == "text"), lambda b: get(b, "text")), "\n")).otherwise(spoken)
    calls = F.transform(F.filter(blocks, lambda b: get(b, "type") == "tool_use"), lambda b: event("tool_call", session, F.coalesce(get(b, "name"), F.lit("unknown")), get(b, "id"), "requested", None, F.coalesce(objects(sub(b, "input")), F.lit("{}"))))
    none = F.array().cast(f"array<{EVENT}>")
    wrong = F.coalesce(F.try_variant_get(v, "$.is_error", "boolean"), F.lit(False))
    said = F.when(F.coalesce(spoken, F.lit("")) != "", F.array(event("assistant_message", session, status=F.coalesce(get(v, "stop_reason"), F.lit("ok")), text=spoken))).otherwise(none)
    payload = F.coalesce(F.try_parse_json(get(v, "payload_json")), sub(v, "payload"))
    daemon = event(
        mapped(mode, DAEMON_KINDS), session, get(payload, "tool_name", "name"), get(payload, "tool_call_id", "id"), F.coalesce(get(payload, "status"), F.when(mode == "tool_call", "requested")),
        F.coalesce(get(payload, "text", "data", "output", "content", "message"), json_plain(payload)), objects(F.coalesce(sub(payload, "args"), sub(payload, "input"))),
    )
    return (
        F.when(mapped(mode, DAEMON_KINDS).isNotNull(), F.array(daemon))
        .when(kind == "system", F.array(event("session_start", session, status=F.coalesce(get(v, "subtype"), F.lit("init")), text=get(v, "cwd"))))
        .when(kind == "user", F.array(event("user_message", session, call=get(v, "parent_tool_use_id"), text=spoken)))
        .when(kind == "assistant", F.concat(said, calls))
        .when(kind == "tool_result", F.array(event("tool_result", session, call=get(v, "tool_use_id"), status=F.when(wrong, "error").otherwise("ok"), text=json_plain(sub(v, "content")))))
        .when(kind == "result", F.array(event("session_end", session, status=get(v, "subtype"), text=get(v, "error"))))
    )


def _scope(v: Column) -> Column:
    data = sub(v, "data")
    kind = F.when(get(v, "scope_category") == "start", "tool_call").otherwise("tool_result")
    one = event(kind, get(v, "metadata.session_id"), F.coalesce(get(v, "name"), F.lit("unknown")), None, F.coalesce(get(v, "metadata.status"), get(v, "scope_category")), json_plain(data), F.coalesce(objects(data), F.lit("{}")))
    agent = event(get(v, "name"), get(v, "metadata.session_id"), text=F.to_json(v))
    return F.when(get(v, "category") == "tool", F.array(one)).when(F.contains(get(v, "name"), F.lit(".subagent")), F.array(agent))


def _steps(v: Column) -> Column:
    session = get(v, "session_id")
    none = F.array().cast(f"array<{EVENT}>")

    def step(s: Column) -> Column:
        calls = F.transform(members(sub(s, "tool_calls")), lambda c: event("tool_call", session, F.coalesce(get(c, "function_name", "name"), F.lit("unknown")), None, "requested", None, F.coalesce(objects(sub(c, "arguments")), F.lit("{}"))))
        said = json_plain(sub(s, "message"))
        spoken = F.when(F.coalesce(said, F.lit("")) != "", F.array(event("assistant_message", session, text=said))).otherwise(none)
        seen = F.when(sub(s, "observation").isNotNull(), F.array(event("tool_result", session, status="ok", text=json_plain(sub(s, "observation"))))).otherwise(none)
        return F.concat(calls, spoken, seen)

    return F.flatten(F.transform(members(sub(v, "steps")), step))


def _normalized(v: Column) -> Column:
    session = get(v, "session.id")
    return F.transform(members(sub(v, "events")), lambda e: event(F.coalesce(get(e, "type"), F.lit("unknown")), F.coalesce(get(e, "session_id"), session), get(e, "tool_name"), get(e, "tool_call_id"), get(e, "status"), get(e, "text"), objects(sub(e, "args"))))


READERS = {"normalized": _normalized, "trajectory": _trajectory, "observer": _observer, "plugin": _plugin, "stream": _stream, "scope": _scope, "steps": _steps}


def read_lines(rows: DataFrame, fmt: str | None = None) -> DataFrame:
    """Events of parsed lines ``(trace_id, block, line, v)``; a file whose format is not known fails.

    The session of a row without one is the last that its file named before; a
    file that names none has its own path.
    """
    if fmt is None:
        first = rows.groupBy("trace_id").agg(F.min_by(format_of(F.col("v")), F.struct("block", "line")).alias("format"))
        rows = rows.join(first, "trace_id")
    else:
        rows = rows.withColumn("format", F.lit(fmt))
    events = None
    for name, reader in READERS.items():
        events = F.when(F.col("format") == name, reader(F.col("v"))) if events is None else events.when(F.col("format") == name, reader(F.col("v")))
    events = events.otherwise(F.raise_error(F.concat(F.lit("unknown trace format: "), F.col("trace_id"))).cast(f"array<{EVENT}>"))
    out = rows.select("trace_id", "block", "line", F.posexplode(events).alias("sub", "e")).select("trace_id", "block", "line", "sub", "e.*")
    order = Window.partitionBy("trace_id").orderBy("block", "line", "sub")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    return out.select(
        "trace_id", (F.row_number().over(order) - 1).cast("long").alias("event_index"), F.coalesce(F.last("session_id", ignorenulls=True).over(so_far), "trace_id").alias("session_id"), "event_type", "tool_name", "tool_call_id", "status", "text", "args"
    )


def read_traces(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """Events of all trace files under a path, of one format or each of its own. One JSON value a line; for whole-file JSON use ``read_documents``."""
    return read_lines(lines(spark, path), fmt)


def read_documents(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """As ``read_traces`` for files that are one JSON value over many lines."""
    raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("trace_id"), F.lit(0).cast("long").alias("block"), F.lit(0).cast("long").alias("line"), F.try_parse_json("value").alias("v"))
    return read_lines(raw.filter("v is not null"), fmt)


def final_answers(events: DataFrame) -> DataFrame:
    """Last assistant text of each trace."""
    said = F.when(F.col("event_type") == "assistant_message", F.col("event_index"))
    return events.groupBy("trace_id").agg(F.max_by("text", said).alias("final_answer"), F.count("*").alias("n_events"))


def infer_call_ids(events: DataFrame) -> DataFrame:
    """Results without an id take that of the only call of their tool in the trace, and say so."""
    calls = events.filter("event_type = 'tool_call' and tool_call_id is not null").groupBy("trace_id", "tool_name").agg(F.count("*").alias("n"), F.min("tool_call_id").alias("only"), F.min("event_index").alias("at")).filter("n = 1").drop("n")
    both = events.join(calls, ["trace_id", "tool_name"], "left")
    infer = (F.col("event_type") == "tool_result") & F.col("tool_call_id").isNull() & (F.col("at") < F.col("event_index"))
    return both.withColumn("id_source", F.when(infer, "inferred").when(F.col("tool_call_id").isNotNull(), "recorded")).withColumn("tool_call_id", F.when(infer, F.col("only")).otherwise(F.col("tool_call_id"))).drop("only", "at")


def call_errors(events: DataFrame) -> DataFrame:
    """Calls and results by id that are not one to one: duplicates and results without a call."""
    ids = events.filter("tool_call_id is not null").groupBy("trace_id", "tool_call_id").agg(F.count_if(F.col("event_type") == "tool_call").alias("calls"), F.count_if(F.col("event_type") == "tool_result").alias("results"))
    problem = F.when(F.col("calls") > 1, "duplicate_call").when(F.col("results") > 1, "duplicate_result").when((F.col("results") > 0) & (F.col("calls") == 0), "orphan_result")
    return ids.withColumn("problem", problem).filter("problem is not null")


