"""Queries over reviews, metrics, queues and registries."""

from __future__ import annotations

from pyspark.sql import functions as F

from runloom.operators import datasets as D, review as R, traces as T
from runloom.operators.rules import PENALTIES
from runloom.plans.comparison import ARMS_SQL, cases
from runloom.plans.evaluation import REVIEW_SQL, reviewed
from runloom.plans.registry import query, with_
from runloom.plans.traces import SIGNAL_SQL, rules, scored, scores
from runloom.plans.views import EVENTS_SQL, SCORES_SQL, trace_events
from runloom.session import load


@query(
    """with items as (select doc_id as item_id, sha256(text) as item_sha256 from documents where doc_id % 5 <> 0),
lab as (select doc_id as item_id, case when doc_id % 7 = 0 then sha256('old') else sha256(text) end as item_sha256, case when doc_id % 3 = 0 then null else 'accept' end as human_label from documents
        union all select doc_id, sha256(text), 'reject' from documents where doc_id % 11 = 0),
r as (select *, count(*) over (partition by item_id) as c from lab where human_label is not null)
select r.item_id, human_label, case when i.item_id is null then 'unknown_item' when c > 1 then 'duplicate_label' when r.item_sha256 <> i.item_sha256 then 'stale_item' end as problem from r left join items i on r.item_id = i.item_id"""
)
def label_item_check(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select(F.col("doc_id").alias("item_id"), F.sha2("text", 256).alias("item_sha256"))
    k = F.col("item_id")
    a = docs.select("item_id", F.when(k % 7 == 0, F.sha2(F.lit("old"), 256)).otherwise(F.col("item_sha256")).alias("item_sha256"), F.when(k % 3 != 0, "accept").alias("human_label"))
    b = docs.filter(k % 11 == 0).withColumn("human_label", F.lit("reject"))
    return R.checked_labels(a.unionAll(b), docs.filter(k % 5 != 0)).select("item_id", "human_label", "problem")


@query(
    with_(
        REVIEW_SQL,
        """select family, contract, chosen, rejected from (select *, row_number() over (partition by family order by contract, chosen, rejected) as nth from (
  select a.family, a.contract, a.doc_id as chosen, b.doc_id as rejected from (select *, score % 4 as contract from rev) a join (select *, score % 4 as contract from rev) b
  on a.family = b.family and a.contract = b.contract and a.human_label = 'accept' and b.human_label in ('reject', 'unsafe'))) where nth <= 25""",
    )
)
def reviewed_preferences(spark, sf_dir):
    rows = reviewed(spark, sf_dir).select(F.col("doc_id").alias("row_id"), "family", (F.col("score") % 4).alias("contract"), "human_label")
    return R.reviewed_preferences(rows, 25)


_CREDIT_SQL = (
    EVENTS_SQL
    + """,
nth as (select *, row_number() over (partition by run_id, event_type order by event_index) as n from ev where event_type in ('tool_call', 'tool_result')),
cr as (select c.run_id, c.n as tool_call_id, c.event_index as call_index, r.event_index as result_index, r.status from nth c left join nth r on c.run_id = r.run_id and c.n = r.n and r.event_type = 'tool_result' where c.event_type = 'tool_call')"""
)


@query(
    with_(
        _CREDIT_SQL,
        "select run_id, call_index, result_index, case status when 'ok' then 'positive' when 'failed' then 'negative' else 'neutral' end as label, case status when 'ok' then 1.0 when 'failed' then -1.0 else 0.0 end::double as reward, case when status is null then 'low' else 'high' end as confidence from cr",
    )
)
def action_credit(spark, sf_dir):
    from pyspark.sql import Window

    tools = trace_events(spark, sf_dir).filter("event_type in ('tool_call', 'tool_result')")
    ids = tools.withColumn("tool_call_id", F.row_number().over(Window.partitionBy("run_id", "event_type").orderBy("event_index")).cast("string"))
    return R.action_credit(R.call_results(ids)).select("run_id", "call_index", "result_index", "label", "reward", "confidence")


@query(
    with_(
        SCORES_SQL,
        """select count(*)::bigint as episodes, count(*) filter (where passed)::bigint as passed, count(*) filter (where not passed)::bigint as failed, round(avg(score), 4) as average_score, count(distinct s.task_family)::bigint as families,
  count(*) filter (where final_answer is null)::bigint as without_answer, count(*) filter (where passed and final_answer is not null)::bigint as eligible, sum(failed_rules)::bigint as failed_rules,
  count(*) filter (where c)::bigint as complete, count(*) filter (where not c)::bigint as incomplete, 0::bigint as not_applicable
from scores s join runs r on s.run_id = r.run_id join (select run_id, bool_and(passed) as c from rules where rule_id in ('required_evidence', 'required_actions', 'required_action_sequences', 'required_event_counts') group by run_id) t on s.run_id = t.run_id""",
    )
)
def dataset_metrics(spark, sf_dir):
    return R.dataset_metrics(scores(spark, sf_dir))


@query(
    with_(
        SCORES_SQL,
        """select task_family, count(*)::bigint as episodes, count(*) filter (where passed)::bigint as positives, sum(failed_rules)::bigint as failures from scores group by task_family""",
    )
)
def family_artifact_metrics(spark, sf_dir):
    cards = scores(spark, sf_dir)
    return R.family_metrics("task_family", {"episodes": cards, "positives": cards.filter("passed"), "failures": D.failure_modes(rules(spark, sf_dir))})


@query(with_(SCORES_SQL, "select s.run_id from scores s join runs r on s.run_id = r.run_id where s.passed and not (s.passed and r.final_answer like '%\"k\": 1%')"))
def label_provenance(spark, sf_dir):
    cards = scores(spark, sf_dir)
    return R.label_provenance(cards, cards.filter("passed and final_answer like '%\"k\": 1%'"))


@query(
    with_(
        SCORES_SQL,
        "select array_to_string(list_filter([case when count(*) = 0 then 'no_episodes' end, case when count(*) filter (where passed) = 0 then 'no_positives' end, case when avg(passed::integer) < 0.5 then 'low_pass_rate' end, case when count(distinct task_family) < 3 then 'few_families' end], lambda x: x is not null), ',') as flags from scores",
    )
)
def quality_flags(spark, sf_dir):
    m = R.dataset_metrics(scores(spark, sf_dir))
    flags = {"no_episodes": F.col("episodes") == 0, "no_positives": F.col("passed") == 0, "low_pass_rate": F.col("passed") / F.col("episodes") < 0.5, "few_families": F.col("families") < 3}
    return R.quality_flags(m, flags).select(F.array_join("flags", ",").alias("flags"))


@query(with_(SCORES_SQL, "select run_id, rule_id, penalty::integer as penalty, case when penalty >= 35 then 'high' when penalty >= 30 then 'medium' else 'low' end as priority from rules where not passed"))
def repair_queue(spark, sf_dir):
    return R.repair_queue(scored(spark, sf_dir), trace_events(spark, sf_dir), PENALTIES).select("run_id", "rule_id", "penalty", "priority")


@query(with_(SCORES_SQL, "select priority, rule_id, count(*)::bigint as n from (select rule_id, case when penalty >= 35 then 'high' when penalty >= 30 then 'medium' else 'low' end as priority from rules where not passed) group by all"))
def repair_metrics(spark, sf_dir):
    return repair_queue(spark, sf_dir).groupBy("priority", "rule_id").agg(F.count("*").alias("n"))


@query(
    with_(
        SCORES_SQL + "," + SIGNAL_SQL[len(EVENTS_SQL) :].lstrip(", \n"),
        """select s.run_id, round(s.score / 100.0::double, 4) as reward, array_to_string(list_filter([case when list_contains(f, 'secret_exposure') then 'rotate_secret' end, case when list_contains(f, 'forbidden_actions') then 'review_policy' end,
  case when not has_final_answer then 'ask_for_answer' end, case when tool_call_count = 0 then 'record_tools' end, case when s.passed then 'keep_as_reference' end], lambda x: x is not null), ',') as actions
from scores s join sig on s.run_id = sig.run_id left join (select run_id, list(rule_id) as f from rules where not passed group by run_id) x on x.run_id = s.run_id""",
    )
)
def run_digest(spark, sf_dir):
    d = R.run_digest(scores(spark, sf_dir), T.trace_signal(trace_events(spark, sf_dir)))
    return d.select("run_id", "reward", F.array_join("actions", ",").alias("actions"))


@query(
    with_(
        SCORES_SQL,
        """select source, subject, action, priority, sha256(subject || '|' || action) as fingerprint from (select *, row_number() over (partition by subject, action order by rank, priority desc) as rn from (
  select 0 as rank, 'repair' as source, task_family as subject, rule_id as action, max(penalty)::bigint as priority from rules where not passed group by all
  union all select 1, 'curriculum', task_family, rule_id, count(*)::bigint from rules where not passed group by all
  union all select 2, 'suite', task_family, 'raise_pass_rate', 1::bigint from scores group by all)) where rn = 1""",
    )
)
def improvement_plan(spark, sf_dir):
    modes = D.failure_modes(rules(spark, sf_dir)).withColumnsRenamed({"task_family": "subject", "rule_id": "action"})
    repair = modes.groupBy("subject", "action").agg(F.max("penalty").alias("priority"))
    curriculum = modes.groupBy("subject", "action").agg(F.count("*").alias("priority"))
    suite = scores(spark, sf_dir).select(F.col("task_family").alias("subject")).distinct().select("subject", F.lit("raise_pass_rate").alias("action"), F.lit(1).alias("priority"))
    return R.improvement_plan({"repair": repair, "curriculum": curriculum, "suite": suite})


@query(
    """select coalesce(e.k, o.k) as case_id, case when o.k is null then 'missing' when e.k is null then 'unexpected' else 'duplicate' end as problem, coalesce(o.n, 0)::bigint as times
from (select c_custkey as k from customer where c_custkey % 9 <> 0) e full join (select o_custkey as k, count(*) as n from orders group by 1) o on e.k = o.k where o.k is null or e.k is null or o.n > 1"""
)
def case_coverage(spark, sf_dir):
    want = load(spark, sf_dir, "customer").filter("c_custkey % 9 <> 0").select(F.col("c_custkey").alias("case_id"))
    return R.case_coverage(want, load(spark, sf_dir, "orders").select(F.col("o_custkey").alias("case_id")), "case_id")


@query("select r_regionkey, r_name, coalesce((select string_agg(n_name, ',' order by n_name) from nation where n_regionkey = r_regionkey and n_nationkey % 2 = 0), '') as aliases from region")
def registry_listing(spark, sf_dir):
    aliases = load(spark, sf_dir, "nation").filter("n_nationkey % 2 = 0").select(F.col("n_regionkey").alias("r_regionkey"), F.col("n_name").alias("alias"))
    return R.registry_listing(load(spark, sf_dir, "region"), aliases, "r_regionkey").select("r_regionkey", "r_name", F.array_join("aliases", ",").alias("aliases"))


@query(with_(ARMS_SQL, "select scenario_id, count(*)::bigint as iterations, count(*) filter (where status = 'F')::bigint as finished, max_by(status, o_orderkey) as latest, round(sum(price), 2)::bigint as total_cost, count(price)::bigint as known_costs from cases group by scenario_id"))
def loop_metrics(spark, sf_dir):
    return R.loop_metrics(cases(spark, sf_dir), "scenario_id", "o_orderkey", "status", "price").withColumn("total_cost", F.col("total_cost").cast("long"))


_SAFETY_SQL = ARMS_SQL + ", saf as (select family as arm, count(*) filter (where price > 100000)::bigint as critical, count(*) filter (where price > 100000 and status = 'F')::bigint as violations from cases group by family), saf2 as (select *, round(coalesce(violations::double / nullif(critical, 0), 0), 6) as violation_rate from saf)"


def _safety(spark, sf_dir):
    rows = cases(spark, sf_dir).withColumnRenamed("family", "arm_id")
    return R.safety_rates(rows.withColumn("grp", F.col("arm_id")), "grp", F.col("price") > 100000, F.col("status") == "F").withColumnRenamed("grp", "arm")


@query(with_(_SAFETY_SQL, "select * from saf2"))
def safety_rates(spark, sf_dir):
    return _safety(spark, sf_dir)


@query(with_(_SAFETY_SQL, "select arm, violation_rate, round(violation_rate - (select violation_rate from saf2 where arm = 0), 6) as difference, violation_rate >= (select violation_rate from saf2 where arm = 0) - 0.01 as non_inferior from saf2"))
def four_arm_non_inferiority(spark, sf_dir):
    return R.non_inferior(_safety(spark, sf_dir), "arm", "violation_rate", 0, 0.01)


@query()
def derivation_identity(spark, sf_dir):
    """Identity of the documents under a recipe; the checksum is tested on its own."""
    return R.derivation_id(load(spark, sf_dir, "documents").select(F.sha2("text", 256).alias("h")), "h", "recipe-v1")


@query(
    """with act as (select o_orderkey as episode_id, case when o_orderkey % 6 = 0 then 'inferred_schema' else 'recorded_exact' end as provenance, o_custkey % 3 as calls, o_orderkey % 10 <> 0 as eligible, o_orderpriority as task from orders),
lab as (select o_orderkey as episode_id, case when o_orderkey % 3 = 0 then 'accept' when o_orderkey % 3 = 1 then 'reject' end as human_label from orders where o_orderkey % 2 = 0)
select a.episode_id, a.task, provenance from act a join lab l on a.episode_id = l.episode_id where human_label = 'accept' and not (calls > 0 and starts_with(provenance, 'inferred')) and eligible"""
)
def reviewed_actions(spark, sf_dir):
    """Accepted action rows; keys that repeat would raise."""
    k = F.col("o_orderkey")
    orders = load(spark, sf_dir, "orders")
    actions = orders.select(k.alias("episode_id"), F.when(k % 6 == 0, "inferred_schema").otherwise("recorded_exact").alias("provenance"), (F.col("o_custkey") % 3).alias("tool_calls"), (k % 10 != 0).alias("eligible"), F.col("o_orderpriority").alias("task"))
    labels = orders.filter(k % 2 == 0).select(k.alias("episode_id"), F.when(k % 3 == 0, "accept").when(k % 3 == 1, "reject").alias("human_label"))
    return R.reviewed_actions(actions, labels).select("episode_id", "task", "provenance")


@query(
    """with r as (select c_custkey as id, c_mktsegment || (c_custkey % 40)::varchar as contract, case c_custkey % 3 when 0 then 'accept' when 1 then 'reject' else 'skip' end as l from customer)
select a.contract, a.id as chosen, b.id as rejected from r a join r b on a.contract = b.contract and a.l = 'accept' and b.l = 'reject'"""
)
def contract_preferences(spark, sf_dir):
    """Accepted and rejected rows of one task contract; stale contracts, self pairs and equal completions would raise."""
    k = F.col("c_custkey")
    contract = F.concat(F.col("c_mktsegment"), (k % 40).cast("string"))
    rows = load(spark, sf_dir, "customer").select(k.alias("episode_id"), contract.alias("contract"), F.when(k % 2 == 0, contract).alias("supplied"), F.when(k % 3 == 0, "accept").when(k % 3 == 1, "reject").otherwise("skip").alias("human_label"), F.col("c_name").alias("completion"))
    return R.contract_preferences(rows)


@query(
    """with lab as (select p_partkey as item_id from part where p_partkey % 2 = 0), itm as (select p_partkey as item_id, p_partkey % 300 as episode_id, p_size % 2 as behaviour from part where p_partkey % 7 <> 0),
eps as (select s_suppkey as episode_id, s_suppkey % 2 as behaviour from supplier union all select s_suppkey, 1 from supplier where s_suppkey % 6 = 0),
f as (select episode_id, count(*) as n, min(behaviour) as seen from eps group by episode_id)
select lab.item_id, case when n is null then 'missing' when n > 1 or behaviour <> seen then 'mismatch' else 'covered' end as status from lab left join itm on lab.item_id = itm.item_id left join f on itm.episode_id = f.episode_id"""
)
def review_coverage(spark, sf_dir):
    """Whether each reviewed item has exactly one episode that behaves alike."""
    part, s = load(spark, sf_dir, "part"), load(spark, sf_dir, "supplier")
    p, k = F.col("p_partkey"), F.col("s_suppkey")
    items = part.filter(p % 7 != 0).select(p.alias("item_id"), (p % 300).alias("episode_id"), (F.col("p_size") % 2).cast("long").alias("behaviour"))
    episodes = s.select(k.alias("episode_id"), (k % 2).alias("behaviour")).unionAll(s.filter(k % 6 == 0).select(k, F.lit(1).cast("long")))
    return R.review_coverage(part.filter(p % 2 == 0).select(p.alias("item_id")), items, episodes)


@query(
    """with l as (select doc_id as item_id, toxic as m, quality as h, case when doc_id % 4 = 0 then 'low' else 'high' end as c, doc_id % 3 = 0 as resolved from labels),
r as (select *, h is not null and m <> h as d from l), t as (select round(1 - count(*) filter (where d)::double / nullif(count(h), 0), 6) as agreement, count(*) filter (where (d or c = 'low') and not resolved) as waiting from r)
select item_id, case when d then 'disagreement' when c = 'low' then 'low_confidence' when h is null then 'uncompared' else 'agreed' end as route, agreement, coalesce(agreement >= 0.8 and waiting = 0, false) as ready from r, t"""
)
def grader_queue(spark, sf_dir):
    """Where each model label goes, and whether the grader may be used."""
    k = F.col("doc_id")
    rows = load(spark, sf_dir, "labels").select(k.alias("item_id"), F.col("toxic").alias("model_label"), F.col("quality").alias("human_label"), F.when(k % 4 == 0, "low").otherwise("high").alias("confidence"), (k % 3 == 0).alias("resolved"))
    return R.grader_queue(rows)
