"""Queries over gates and decisions."""

from __future__ import annotations

from pyspark.sql import functions as F

from runloom.operators import gates as G
from runloom.plans.registry import query, with_
from runloom.plans.traces import rules, scores
from runloom.plans.views import SCORES_SQL, trace_events
from runloom.session import load

_SUITE = {"min_pass_rate": 0.5, "min_average_score": 60, "max_failed": 10, "max_critical_failures": 5, "forbid_failed_rules": ["required_state", "budget"], "forbid_critical_rules": ["secret_exposure"]}
_FAMILIES = {"family_1": {"min_pass_rate": 0.1, "forbid_failed_rules": ["secret_exposure"]}, "family_9": {"min_pass_rate": 0.0}}


@query(
    with_(
        SCORES_SQL + """,
m as (
  select coalesce(task_family, '*') as scope, round(count(*) filter (where passed)::double / count(*), 4) as pass_rate, round(avg(score), 2) as average_score, count(*) filter (where not passed)::double as failed
  from scores group by grouping sets ((task_family), ())),
f as (select coalesce(task_family, '*') as scope, rule_id, count(*)::double as n from rules where not passed group by grouping sets ((task_family, rule_id), (rule_id))),
crit as (select count(*)::double as n from rules where not passed and penalty >= 30),
checks as (
  select '*' as scope, 'min_pass_rate' as check_id, (select pass_rate from m where scope = '*') as actual, 0.5::double as bound, 'min' as kind
  union all select '*', 'min_average_score', (select average_score from m where scope = '*'), 60, 'min'
  union all select '*', 'max_failed', (select failed from m where scope = '*'), 10, 'max'
  union all select '*', 'max_critical_failures', (select n from crit), 5, 'max'
  union all select '*', 'forbid_failed_rules:' || r, coalesce((select n from f where scope = '*' and rule_id = r), 0), 0, 'max' from (values ('required_state'), ('budget')) t(r)
  union all select '*', 'forbid_critical_rules:secret_exposure', coalesce((select n from f where scope = '*' and rule_id = 'secret_exposure'), 0), 0, 'max'
  union all select 'family_1', 'min_pass_rate', (select pass_rate from m where scope = 'family_1'), 0.1, 'min'
  union all select 'family_1', 'forbid_failed_rules:secret_exposure', coalesce((select n from f where scope = 'family_1' and rule_id = 'secret_exposure'), 0), 0, 'max'
  union all select 'family_9', 'min_pass_rate', (select pass_rate from m where scope = 'family_9'), 0.0, 'min'),
judged as (select scope, check_id, actual, bound, coalesce(case kind when 'min' then actual >= bound else actual <= bound end, false) as passed from checks)""",
        """select *, (select bool_and(passed) from judged) as gate_passed from judged""",
    )
)
def suite_gate(spark, sf_dir):
    """A suite's gate with lists of rules and sub-gates of families; one of the families does not exist and fails."""
    return G.suite_gate(scores(spark, sf_dir), rules(spark, sf_dir).withColumn("critical", F.col("penalty") >= 30), _SUITE, _FAMILIES)


@query(
    """with a as (select o_orderpriority as action, o_orderstatus as status, case when o_totalprice > 300000 then 'critical' when o_totalprice > 200000 then 'high' else 'low' end as priority from orders),
c as (select count(*)::double as n, count(distinct action)::double as actions, count(distinct priority)::double as priorities, count(distinct status)::double as statuses,
  count(*) filter (where action = '1-URGENT')::double as truck, count(*) filter (where action = '9-NEVER')::double as sleigh, count(*) filter (where priority = 'critical')::double as crit, count(*) filter (where status = 'F')::double as resolved from a),
k as (select unnest([{check_id: 'min_rows', actual: n, bound: 10::double, passed: n >= 10}, {check_id: 'max_distinct_action', actual: actions, bound: 5::double, passed: actions <= 5},
  {check_id: 'require_action:1-URGENT', actual: truck, bound: 0::double, passed: truck > 0}, {check_id: 'require_action:9-NEVER', actual: sleigh, bound: 0::double, passed: sleigh > 0},
  {check_id: 'forbid_priority:critical', actual: crit, bound: 0::double, passed: crit = 0}, {check_id: 'require_status:F', actual: resolved, bound: 0::double, passed: resolved > 0}], recursive := true) from c)
select '*' as scope, *, (select bool_and(passed) from k) as gate_passed from k"""
)
def action_ledger_gate(spark, sf_dir):
    """A ledger's gate: rows, distinct actions, forbidden priorities, required actions and states."""
    rows = load(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("action"), F.col("o_orderstatus").alias("status"), F.when(F.col("o_totalprice") > 300000, "critical").when(F.col("o_totalprice") > 200000, "high").otherwise("low").alias("priority")
    )
    policy = {"min_rows": 10, "max_distinct_action": 5, "require_action": ["1-URGENT", "9-NEVER"], "forbid_priority": ["critical"], "require_status": ["F"]}
    return G.list_gate(rows, policy, action="action", priority="priority", status="status")


#: Kinds of evidence that the admission of sampled rows and a promotion need.
SAMPLING = ("agentic_rollout_receipt", "model_grader_gate", "review_calibration", "reviewed_gate")
PROMOTION = ("evidence_bundle", "eval_summary", "promotion_ledger_gate", "compare_gate", "model_card", "dataset_card", "rollback_metadata", "license_review", "redaction_check", "safety_gate")


def _evidence_sql(kinds: tuple[str, ...], table: str, key: str, group: str, salt: int) -> str:
    return f"""with kinds as (select unnest({list(kinds)!r}) as kind, unnest(range({len(kinds)})) as i),
refs as (select {group} as candidate, (select kind from kinds where i = {key} % {len(kinds)}) as kind, {key} % {salt} <> 0 as passed from {table}),
cnt as (select candidate, kind, count(*)::bigint as present, count(*) filter (where passed)::bigint as passing from refs group by candidate, kind),
rows_ as (select c.candidate, k.kind || '_present_and_passing' as check_id, coalesce(present, 0) as present, coalesce(passing, 0) as passing, coalesce(present = passing, false) as passed
  from (select distinct candidate from refs) c cross join kinds k left join cnt on cnt.candidate = c.candidate and cnt.kind = k.kind)
select *, case when bool_and(passed) over (partition by candidate) then 'promote' else 'block' end as decision from rows_"""


def _refs(spark, sf_dir, kinds, table, key, group, salt):
    k = F.col(key)
    kind = F.element_at(F.array(*map(F.lit, kinds)), (k % len(kinds)).cast("int") + 1)
    return load(spark, sf_dir, table).select(group.alias("candidate"), kind.alias("kind"), (k % salt != 0).alias("passed"))


@query(_evidence_sql(SAMPLING, "customer", "c_custkey", "c_nationkey", 13))
def rejection_sampling_gate(spark, sf_dir):
    """Whether each candidate's receipts, graders, calibrations and reviews are all there and pass."""
    return G.evidence_gate(_refs(spark, sf_dir, SAMPLING, "customer", "c_custkey", F.col("c_nationkey"), 13), "candidate", SAMPLING)


@query(_evidence_sql(PROMOTION, "part", "p_partkey", "p_brand", 11))
def promotion_decision(spark, sf_dir):
    """Whether all evidence that a promotion needs is there and passes, for each candidate."""
    return G.evidence_gate(_refs(spark, sf_dir, PROMOTION, "part", "p_partkey", F.col("p_brand"), 11), "candidate", PROMOTION)


_ARMS = ("baseline", "trace_only", "treated")
_CASES_SQL = """cs as (
  select unnest(['baseline', 'trace_only', 'treated']) as arm, s_suppkey as scenario_id, s_nationkey::varchar as fingerprint, unnest([s_acctbal > 4000, s_acctbal > 2000, s_acctbal > 0]) as passed,
    unnest([s_suppkey % 50, s_suppkey % 60, s_suppkey % 90])::double as score, unnest([s_suppkey % 7 = 0, s_suppkey % 9 = 0, s_suppkey % 31 = 0]) as critical, s_nationkey % 3 as pool, s_suppkey % 4 as "repeat", s_suppkey % 2 as seed from supplier)"""


def _cases(spark, sf_dir):
    k, a = F.col("s_suppkey"), F.col("s_acctbal")
    arms = [F.struct(F.lit(n).alias("arm"), (a > least).alias("passed"), (k % m).cast("double").alias("score"), (k % c == 0).alias("critical")) for n, least, m, c in zip(_ARMS, (4000, 2000, 0), (50, 60, 90), (7, 9, 31), strict=True)]
    rows = load(spark, sf_dir, "supplier").select(k.alias("scenario_id"), F.col("s_nationkey").cast("string").alias("fingerprint"), (F.col("s_nationkey") % 3).alias("pool"), (k % 4).alias("repeat"), (k % 2).alias("seed"), F.inline(F.array(*arms)))
    return rows.select("arm", "scenario_id", "fingerprint", "passed", "score", "critical", "pool", "repeat", "seed")


@query(
    with_(
        _CASES_SQL + """,
b as (select arm, round(avg(passed::integer), 6) as pass_rate, round(avg(score), 6) as average_score, sum(critical::integer)::double as critical_failures from cs group by arm),
u as (unpivot b on pass_rate, average_score, critical_failures into name measure value value)""",
        """select case when c.measure = 'critical_failures' then 'fewer_' else 'higher_' end || c.measure || '_than_' || r.arm as check_id, c.value as candidate, r.value as reference, true as comparable,
  case when c.measure = 'critical_failures' then c.value < r.value else c.value > r.value end as passed
from u c join u r on c.measure = r.measure where c.arm = 'treated' and r.arm <> 'treated'""",
    )
)
def three_arm_comparison(spark, sf_dir):
    """The treated arm against the two others, over the same scenarios."""
    return G.three_arms(_cases(spark, sf_dir), _ARMS)


@query(
    with_(
        _CASES_SQL + """,
k as (select pool, scenario_id, "repeat", seed, max(score) filter (where arm = 'baseline') as s0, max(score) filter (where arm = 'trace_only') as s1, max(score) filter (where arm = 'treated') as s2 from cs group by all),
e as (select round(avg(s2 - s0), 6) as d0, round(avg(s2 - s1), 6) as d1 from k)""",
        """select 'three_required_arms_present' as check_id, 3::double as actual, true as passed union all select 'identical_paired_observations', 0, true union all select 'minimum_repeats_per_scenario', 1, false
union all select 'effect_over_baseline', d0, d0 >= 12 from e union all select 'effect_over_trace_only', d1, d1 >= 12 from e""",
    )
)
def promotion_evidence(spark, sf_dir):
    """Arms, pairing, repeats and effects before a promotion; each scenario has one repeat where two are asked for."""
    return G.promotion_evidence(_cases(spark, sf_dir), _ARMS, 2, 12)
