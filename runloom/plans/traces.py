"""Queries over traces: normalisation, predicates, rules, scorecards and their metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from runloom.functions import predicates as P
from runloom.operators import rules as R, traces as T
from runloom.plans.registry import query, with_
from runloom.plans.views import EVENTS_SQL, RUNS_SQL, SCENARIO, SCORES_SQL, runs, trace_events


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = trace_events(spark, sf_dir)
    return R.evaluate(events, runs(events), SCENARIO)


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.scorecards(scored(spark, sf_dir), SCENARIO["scoring"]["pass_threshold"])


def rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.rule_rows(scored(spark, sf_dir))


@query(with_(EVENTS_SQL, "select event_id, run_id, event_index, event_type, tool_name, status, text from ev"))
def normalize_events(spark, sf_dir):
    return trace_events(spark, sf_dir).select("event_id", "run_id", "event_index", "event_type", "tool_name", "status", "text")


@query(with_(EVENTS_SQL, "select run_id, event_index, last_value(tool_name ignore nulls) over (partition by run_id order by event_index rows unbounded preceding) as tool_name from ev"))
def carry_forward_tool(spark, sf_dir):
    return T.carry_forward(trace_events(spark, sf_dir), ["tool_name"], "run_id", "event_index").select("run_id", "event_index", "tool_name")


SIGNAL_SQL = (
    EVENTS_SQL
    + """,
sig0 as (
  select run_id, count(*)::bigint as event_count, count(distinct event_type)::bigint as event_type_count,
         coalesce(max_by(text, event_index) filter (where event_type = 'tool_result'), '') as fa,
         count(*) filter (where event_type = 'tool_call')::bigint as tool_call_count,
         count(*) filter (where event_type = 'tool_result')::bigint as tool_result_count
  from ev group by run_id),
sig as (
  select run_id, event_count, event_type_count, trim(fa) <> '' as has_final_answer, length(fa)::bigint as final_answer_chars,
         tool_call_count, tool_result_count, 0::bigint as api_call_count, 0::bigint as subagent_event_count, 0::bigint as approval_event_count,
         tool_call_count + tool_result_count > 0 as has_tool_or_api_events,
         list_filter([case when event_count = 0 then 'empty_trace' end, case when trim(fa) = '' then 'missing_final_answer' end,
           case when tool_call_count + tool_result_count = 0 then 'no_tool_or_api_events' end,
           case when tool_call_count > 0 and tool_call_count <> tool_result_count then 'tool_call_result_imbalance' end], lambda x: x is not null) as risks
  from sig0)"""
)


@query(with_(SIGNAL_SQL, "select * exclude (risks), array_to_string(risks, ',') as risks from sig"))
def trace_signal(spark, sf_dir):
    return T.trace_signal(trace_events(spark, sf_dir)).withColumn("risks", F.array_join("risks", ","))


@query(
    with_(
        SIGNAL_SQL,
        """select count(*)::bigint as run_count, coalesce(sum(event_count), 0)::bigint as total_event_count, round(sum(event_count)::double / count(*), 2) as average_event_count,
  min(event_count) as min_event_count, max(event_count) as max_event_count, count(*) filter (where has_final_answer)::bigint as runs_with_final_answer,
  count(*) filter (where not has_final_answer)::bigint as empty_final_answer_count, round(count(*) filter (where has_final_answer)::double / count(*), 4) as final_answer_rate,
  count(*) filter (where has_tool_or_api_events)::bigint as runs_with_tool_or_api_events, round(count(*) filter (where has_tool_or_api_events)::double / count(*), 4) as tool_or_api_run_rate,
  sum(tool_call_count)::bigint as tool_call_count, sum(tool_result_count)::bigint as tool_result_count from sig""",
    )
)
def observability_metrics(spark, sf_dir):
    return T.observability_metrics(T.trace_signal(trace_events(spark, sf_dir)))


@query(with_(SIGNAL_SQL, "select risk as value, count(*)::bigint as n from (select unnest(risks) as risk from sig) group by risk"))
def risk_counts(spark, sf_dir):
    return T.value_counts(T.trace_signal(trace_events(spark, sf_dir)).select(F.explode("risks").alias("risk")), "risk")


@query(with_(EVENTS_SQL, "select event_type, count(*)::bigint as n from ev group by event_type"))
def event_type_counts(spark, sf_dir):
    return T.value_counts(trace_events(spark, sf_dir), "event_type", "event_type")


@query(
    with_(
        EVENTS_SQL,
        """select event_id, event_type = 'tool_call' and k >= 0 and k = 7 as where_equals, contains(text, '"k": 1') as where_contains,
  regexp_matches(coalesce(props, ''), 'k.*[02468]\\}$', 's') as where_matches, k is not null as where_present from ev""",
    )
)
def predicate_where(spark, sf_dir):
    events = trace_events(spark, sf_dir).withColumn("doc", F.try_parse_json("props"))
    cols = {c: F.col(c) for c in ("event_type", "tool_name", "status", "text", "props")}
    item = lambda **x: P.event_predicate(x, cols, F.col("doc"))
    return events.select(
        "event_id",
        item(event_type="tool_call", where={"k": {"equals": 7}}).alias("where_equals"),
        item(field_contains={"text": '"k": 1'}).alias("where_contains"),
        item(field="props", matches="k.*[02468]\\}$").alias("where_matches"),
        item(where={"k": {"present": True}}).alias("where_present"),
    )


#: A nested document for wildcard paths, from a run's events.
_DOC_SQL = EVENTS_SQL + ", docs as (select run_id, list({tool: tool_name, ok: status = 'ok', k: k}) as items from ev where tool_name is not null group by run_id)"


@query(
    with_(
        _DOC_SQL,
        """select run_id, len(list_filter(items, lambda x: x.tool = 'tool_1')) > 0 as any_tool, len(list_filter(items, lambda x: x.tool = 'tool_1' and not x.ok)) > 0 as same_item,
  len(list_filter(items, lambda x: x.tool = 'tool_1')) > 0 and len(list_filter(items, lambda x: not x.ok)) > 0 as across_items from docs""",
    )
)
def predicate_where_any(spark, sf_dir):
    tools = trace_events(spark, sf_dir).filter("tool_name is not null")
    docs = tools.groupBy("run_id").agg(F.collect_list(F.struct(F.col("tool_name").alias("tool"), (F.col("status") == "ok").alias("ok"), "k")).alias("items"))
    state = docs.select("run_id", F.parse_json(F.to_json(F.struct("items"))).alias("state"))
    both = {"where": {"items.*.tool": "tool_1", "items.*.ok": {"equals": False}}}
    return state.select(
        "run_id",
        P.state_predicate({"where": {"items.*.tool": {"equals": "tool_1"}}}, F.col("state")).alias("any_tool"),
        P.state_predicate({"where_any": {"path": "items", "where": {"tool": "tool_1", "ok": False}}}, F.col("state")).alias("same_item"),
        P.state_predicate(both, F.col("state")).alias("across_items"),
    )


def _rule(rule: str):
    def run(spark, sf_dir):
        return rules(spark, sf_dir).filter(F.col("rule_id") == rule).select("run_id", "passed")

    run.__name__ = {"required_action_sequences": "rule_sequence"}.get(rule, f"rule_{rule}")
    return query(with_(SCORES_SQL, f"select run_id, passed from rules where rule_id = '{rule}'"))(run)


for _name in R.PENALTIES:
    _rule(_name)


@query(with_(SCORES_SQL, "select run_id, result_after.at as last_index from result_after"))
def sequence_positions(spark, sf_dir):
    found = scored(spark, sf_dir).select("run_id", F.explode("items").alias("x")).filter("x.rule_id = 'required_action_sequences' and x.passed")
    return found.select("run_id", F.col("x.event_index").alias("last_index"))


@query(with_(SCORES_SQL, "select run_id, task_family, score, passed, failed_rules from scores"))
def scorecard(spark, sf_dir):
    return scores(spark, sf_dir).select("run_id", "task_family", "score", "passed", F.size("failed_rules").cast("long").alias("failed_rules"))


@query(
    with_(
        SCORES_SQL,
        """select task_family, grouping(task_family)::integer as all_families, count(*)::bigint as runs, count(*) filter (where passed)::bigint as passed,
  round(count(*) filter (where passed)::double / count(*), 4) as pass_rate, round(sum(score)::double / count(*), 2) as average_score, min(score) as min_score, max(score) as max_score
from scores group by grouping sets ((task_family), ())""",
    )
)
def suite_metrics(spark, sf_dir):
    """Pass rate and scores over the suite and for each family, in one pass by grouping sets."""
    return suite(scores(spark, sf_dir))


def suite(cards: DataFrame) -> DataFrame:
    n = F.count("*")
    return cards.groupingSets([["task_family"], []], "task_family").agg(
        F.grouping("task_family").cast("int").alias("all_families"),
        n.alias("runs"),
        F.count_if("passed").alias("passed"),
        T.rate(F.count_if("passed"), n).alias("pass_rate"),
        T.rate(F.sum("score"), n, 2).alias("average_score"),
        F.min("score").alias("min_score"),
        F.max("score").alias("max_score"),
    )


@query(
    with_(
        SCORES_SQL,
        """select rule_id, count(*)::bigint as rule_count, count(*) filter (where passed)::bigint as passed, count(*) filter (where not passed)::bigint as failed,
  count(*) filter (where not passed and ref)::bigint as failed_with_evidence, count(*) filter (where not passed and not ref)::bigint as failed_without_evidence
from (select r.rule_id, r.passed, case r.rule_id when 'forbidden_actions' then h.forbidden > 0 when 'secret_exposure' then h.secrets > 0 when 'required_evidence' then h.looked > 0 or h.bad_errors > 0 when 'required_actions' then h.called > 0 else false end as ref
  from rules r join hits h on r.run_id = h.run_id) group by rule_id""",
    )
)
def evidence_coverage(spark, sf_dir):
    """A rule's references are the event indexes that its items name."""
    e = scored(spark, sf_dir)
    refs = F.size(F.filter("kept", lambda x: (x["rule_id"] == F.col("rule_id")) & x["event_index"].isNotNull()))
    return T.evidence_coverage(R.rule_rows(e.withColumn("kept", F.col("items"))).select("run_id", "rule_id", "passed", refs.alias("evidence_refs")))


@query(
    with_(
        EVENTS_SQL,
        """select run_id, tool_name, nth, max(event_index) filter (where event_type = 'tool_call') as call_index, max(event_index) filter (where event_type = 'tool_result') as result_index
from (select *, row_number() over (partition by run_id, tool_name, event_type order by event_index)::bigint as nth from ev where event_type in ('tool_call', 'tool_result'))
group by run_id, tool_name, nth""",
    )
)
def call_result_fifo(spark, sf_dir):
    return T.match_calls(trace_events(spark, sf_dir))


@query(
    with_(
        EVENTS_SQL,
        """select tool_name, 'k' as argument, 'integer' as types, count(k)::bigint as uses, count(*)::bigint as calls, count(k) = count(*) as required
from ev where event_type = 'tool_call' group by tool_name having count(k) > 0""",
    )
)
def tool_schema_inference(spark, sf_dir):
    return T.tool_signatures(trace_events(spark, sf_dir))


_PARENTS_SQL = """
sess as (select distinct user_id, (user_id % 7)::bigint as grp from events),
ranked as (select grp, user_id, row_number() over (partition by grp order by user_id) as rn from sess where user_id % 7 <> 3),
edges as (select 'group_' || grp::varchar as run_id, user_id::varchar as child, lag(user_id, 3) over (partition by grp order by user_id)::varchar as parent from ranked where rn <= 24)"""


@query(
    "with recursive "
    + _PARENTS_SQL.strip()
    + """,
walk as (
  select run_id, parent as at, 1 as depth from edges where parent is not null
  union all
  select w.run_id, e.parent, w.depth + 1 from walk w join edges e on w.run_id = e.run_id and w.at = e.child where e.parent is not null)
select run_id, max(depth)::bigint as max_depth from walk group by run_id"""
)
def session_depth(spark, sf_dir):
    from pyspark.sql import Window

    from runloom.session import load

    sess = load(spark, sf_dir, "events").select("user_id", (F.col("user_id") % 7).alias("grp")).filter("user_id % 7 <> 3").distinct()
    w = Window.partitionBy("grp").orderBy("user_id")
    ranked = sess.withColumn("rn", F.row_number().over(w)).withColumn("parent", F.lag("user_id", 3).over(w)).filter("rn <= 24")
    edges = ranked.select(F.concat(F.lit("group_"), F.col("grp").cast("string")).alias("run_id"), F.col("user_id").cast("string").alias("session_id"), F.col("parent").cast("string").alias("parent_session_id"))
    return R.subagent_depth(edges)
