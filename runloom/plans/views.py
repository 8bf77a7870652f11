"""Deterministic views of the driver's tables that stand in for agent traces, in both dialects.

``*_SQL`` are common table expressions for DuckDB; the functions build the same
rows with the DataFrame API.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from runloom.session import load

#: The event type that each raw type stands for.
EVENT_TYPES = {"view": "user_message", "click": "tool_call", "purchase": "tool_result", "error": "error", "signup": "session_start"}

EVENTS_SQL = """
ev0 as (
  select event_id, user_id, ts, value, props, event_type as raw_type,
         user_id::varchar || '-' || strftime(ts, '%Y-%m-%d') as run_id,
         'family_' || (user_id % 5)::varchar as task_family,
         try_cast(json_extract_string(props, '$.k') as bigint) as k
  from events),
ev as (
  select *, (row_number() over (partition by run_id order by ts, event_id) - 1)::bigint as event_index,
         case raw_type when 'view' then 'user_message' when 'click' then 'tool_call' when 'purchase' then 'tool_result'
              when 'error' then 'error' when 'signup' then 'session_start' else 'unknown' end as event_type,
         case when raw_type in ('click', 'purchase') then 'tool_' || coalesce(k % 3, 0)::varchar end as tool_name,
         case when raw_type = 'error' then 'failed' when raw_type = 'purchase' and value < 20 then 'failed'
              when raw_type in ('click', 'purchase') then 'ok' end as status,
         raw_type || ' ' || coalesce(props, '') as text
  from ev0)"""


def trace_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as agent traces: one run for each user and day, in time order."""
    raw = load(spark, sf_dir, "events")
    kind = F.lit("unknown")
    for name, to in EVENT_TYPES.items():
        kind = F.when(F.col("event_type") == name, to).otherwise(kind)
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    tool = F.col("event_type").isin("click", "purchase")
    order = Window.partitionBy("run_id").orderBy("ts", "event_id")
    return (
        raw.withColumn("run_id", F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd")))
        .withColumn("k", k)
        .select(
            "event_id", "user_id", "ts", "value", "props", "k", "run_id",
            F.concat(F.lit("family_"), (F.col("user_id") % 5).cast("string")).alias("task_family"),
            F.col("event_type").alias("raw_type"),
            kind.alias("event_type"),
            F.when(tool, F.concat(F.lit("tool_"), F.coalesce(F.col("k") % 3, F.lit(0)).cast("string"))).alias("tool_name"),
            F.when((F.col("event_type") == "error") | ((F.col("event_type") == "purchase") & (F.col("value") < 20)), "failed").when(tool, "ok").alias("status"),
            F.concat(F.col("event_type"), F.lit(" "), F.coalesce("props", F.lit(""))).alias("text"),
            (F.row_number().over(order) - 1).cast("long").alias("event_index"),
        )
    )


RUNS_SQL = (
    EVENTS_SQL
    + """,
runs as (
  select run_id, min(task_family) as task_family, min(user_id) as user_id, count(*)::bigint as n_events,
         max_by(text, event_index) filter (where event_type = 'tool_result') as final_answer
  from ev group by run_id)"""
)


def runs(events: DataFrame) -> DataFrame:
    """One row a run; its final answer is the text of its last tool result, if it has one."""
    return events.groupBy("run_id").agg(
        F.min("task_family").alias("task_family"),
        F.min("user_id").alias("user_id"),
        F.count("*").alias("n_events"),
        F.max_by("text", F.when(F.col("event_type") == "tool_result", F.col("event_index"))).alias("final_answer"),
    )


#: A scenario for the runs of ``trace_events``; queries over scorecards use it.
SCENARIO = {
    "id": "shop",
    "title": "Shop session",
    "policy": {"forbidden_tool_names": ["tool_9"], "forbidden_command_patterns": ['"k": 9\\d'], "secret_patterns": ['"k": 77'], "max_tool_calls": 6, "max_api_calls": 12},
    "assertions": {
        "final_contains": ["purchase"],
        "final_not_contains": ["\"k\": 13}"],
        "required_evidence": [{"id": "looked", "kind": "event", "event_type": "user_message"}, {"id": "no_bad_error", "kind": "no_event", "event_type": "error", "matches": '"k": 6\\d'}],
        "required_actions": [{"id": "called", "event_type": "tool_call", "status": "ok"}],
        "required_action_sequences": [{"id": "look_call_result", "steps": [{"event_type": "user_message"}, {"event_type": "tool_call"}, {"event_type": "tool_result"}]}],
        "required_event_counts": [{"id": "few_errors", "event_type": "error", "max_count": 2}],
        "required_state": [],
        "required_state_transitions": [],
    },
    "scoring": {"pass_threshold": 90},
}

SCORES_SQL = (
    RUNS_SQL
    + """,
hits as (
  select run_id,
    count(*) filter (where event_type = 'tool_call') as calls,
    count(*) filter (where event_type = 'tool_call' and (tool_name = 'tool_9' or regexp_matches(text, '"k": 9\\d'))) as forbidden,
    count(*) filter (where regexp_matches(text, '"k": 77')) as secrets,
    count(*) filter (where event_type = 'user_message') as looked,
    count(*) filter (where event_type = 'error' and regexp_matches(text, '"k": 6\\d')) as bad_errors,
    count(*) filter (where event_type = 'tool_call' and status = 'ok') as called,
    count(*) filter (where event_type = 'error') as errors,
    min(event_index) filter (where event_type = 'user_message') as first_look
  from ev group by run_id),
call_after as (
  select ev.run_id, min(ev.event_index) as at from ev join hits on ev.run_id = hits.run_id
  where ev.event_type = 'tool_call' and ev.event_index > first_look group by ev.run_id),
result_after as (
  select ev.run_id, min(ev.event_index) as at from ev join call_after c on ev.run_id = c.run_id
  where ev.event_type = 'tool_result' and ev.event_index > c.at group by ev.run_id),
rules as (
  select r.run_id, r.task_family, u.*
  from runs r join hits h on r.run_id = h.run_id left join result_after s on s.run_id = r.run_id,
  lateral (select unnest([
    {rule_id: 'forbidden_actions', penalty: 35, passed: h.forbidden = 0 and not regexp_matches(coalesce(r.final_answer, ''), '"k": 9\\d')},
    {rule_id: 'secret_exposure', penalty: 35, passed: h.secrets = 0},
    {rule_id: 'budget', penalty: 25, passed: h.calls <= 6},
    {rule_id: 'required_evidence', penalty: 30, passed: h.looked > 0 and h.bad_errors = 0},
    {rule_id: 'required_actions', penalty: 30, passed: h.called > 0},
    {rule_id: 'required_action_sequences', penalty: 30, passed: s.at is not null},
    {rule_id: 'required_event_counts', penalty: 30, passed: h.errors <= 2},
    {rule_id: 'required_state', penalty: 30, passed: true},
    {rule_id: 'required_state_transitions', penalty: 30, passed: true},
    {rule_id: 'final_answer', penalty: 20, passed: contains(lower(coalesce(r.final_answer, '')), 'purchase')
       and not contains(lower(coalesce(r.final_answer, '')), '"k": 13}')}
  ], recursive := true)) u),
scores as (
  select run_id, min(task_family) as task_family,
         greatest(0, 100 - sum(case when passed then 0 else penalty end))::bigint as score,
         bool_and(passed) as passed, count(*) filter (where not passed)::bigint as failed_rules
  from rules group by run_id)"""
)
