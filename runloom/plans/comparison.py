"""Queries that compare arms and iterations, ledgers and gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from runloom.operators import comparison as C, traces as T
from runloom.plans.registry import query, with_
from runloom.plans.traces import scores, suite
from runloom.plans.views import SCORES_SQL
from runloom.session import load

ARMS_SQL = """
cases as (
  select o_custkey // 2 as scenario_id, o_custkey % 2 as arm, o_orderpriority as rule_id, o_orderkey, floor(o_totalprice)::bigint as price, year(o_orderdate)::integer as iteration,
         o_orderstatus as status, o_custkey % 5 as family from orders),
arm as (select scenario_id, arm, (sum(price) % 101)::bigint as score, sum(price) % 101 >= 50 as passed from cases group by scenario_id, arm),
ruled as (select scenario_id, arm, rule_id, max(price) < 250000 as passed from cases group by scenario_id, arm, rule_id)"""


def cases(spark, sf_dir):
    return load(spark, sf_dir, "orders").select(
        F.floor(F.col("o_custkey") / 2).cast("long").alias("scenario_id"), (F.col("o_custkey") % 2).alias("arm"), F.col("o_orderpriority").alias("rule_id"), "o_orderkey",
        F.floor("o_totalprice").cast("long").alias("price"), F.year("o_orderdate").alias("iteration"), F.col("o_orderstatus").alias("status"), (F.col("o_custkey") % 5).alias("family"),
    )


def arms(spark, sf_dir):
    rows = cases(spark, sf_dir).groupBy("scenario_id", "arm").agg((F.sum("price") % 101).cast("long").alias("score")).withColumn("passed", F.col("score") >= 50)
    return rows.filter("arm = 0").drop("arm"), rows.filter("arm = 1").drop("arm")


def ruled(spark, sf_dir):
    rows = cases(spark, sf_dir).groupBy("scenario_id", "arm", "rule_id").agg((F.max("price") < 250000).alias("passed"))
    return rows.filter("arm = 0").drop("arm"), rows.filter("arm = 1").drop("arm")


COMPARE_SQL = (
    ARMS_SQL
    + """,
cmp as (
  select coalesce(b.scenario_id, c.scenario_id) as scenario_id,
    case when c.scenario_id is null then 'missing' when b.scenario_id is null then 'new' when b.passed and not c.passed then 'regressed' when not b.passed and c.passed then 'fixed' else 'unchanged' end as status,
    b.score as baseline_score, c.score as candidate_score, c.score - b.score as score_delta
  from (select * from arm where arm = 0) b full join (select * from arm where arm = 1) c on b.scenario_id = c.scenario_id)"""
)


@query(with_(COMPARE_SQL, "select *, status in ('missing', 'regressed') as regression from cmp"))
def compare_suites(spark, sf_dir):
    return C.compare_suites(*arms(spark, sf_dir))


@query(
    with_(
        ARMS_SQL,
        """select coalesce(b.scenario_id, c.scenario_id) as scenario_id, coalesce(b.rule_id, c.rule_id) as rule_id,
  case when b.passed and not c.passed then 'regressed' when not b.passed and c.passed then 'fixed' else 'unchanged' end as change
from (select * from ruled where arm = 0) b full join (select * from ruled where arm = 1) c on b.scenario_id = c.scenario_id and b.rule_id = c.rule_id""",
    )
)
def compare_rules(spark, sf_dir):
    return C.compare_rules(*ruled(spark, sf_dir), "scenario_id", "rule_id")


@query(
    with_(
        ARMS_SQL,
        """select rule_id, count(*) filter (where not passed and arm = 0)::bigint as before, count(*) filter (where not passed and arm = 1)::bigint as after,
  (count(*) filter (where not passed and arm = 1) - count(*) filter (where not passed and arm = 0))::bigint as delta from ruled group by rule_id having count(*) filter (where not passed) > 0""",
    )
)
def failure_deltas(spark, sf_dir):
    return C.failure_deltas(*ruled(spark, sf_dir))


PAIRS_SQL = COMPARE_SQL + ", prs as (select scenario_id, score_delta as candidate_score_delta, abs(score_delta) as score_gap, case when score_delta > 0 then 'candidate' else 'baseline' end as chosen_side from cmp where abs(score_delta) >= 10)"


@query(with_(PAIRS_SQL, "select * from prs"))
def compare_pairs(spark, sf_dir):
    return C.pair_rows(*arms(spark, sf_dir), 10)


@query(with_(PAIRS_SQL, "select chosen_side, count(distinct scenario_id)::bigint as scenarios, sum(score_gap)::bigint as total_gap from prs group by chosen_side"))
def movement_summary(spark, sf_dir):
    return C.movement(C.pair_rows(*arms(spark, sf_dir), 10))


_POINTS_SQL = ARMS_SQL + ", pts as (select rule_id, iteration, count(*) filter (where price >= 250000)::bigint as failures from cases group by rule_id, iteration)"


def _points(spark, sf_dir):
    return cases(spark, sf_dir).groupBy("rule_id", "iteration").agg(F.count_if(F.col("price") >= 250000).alias("failures"))


@query(with_(_POINTS_SQL, "select *, failures - lag(failures) over (partition by rule_id order by iteration) as delta from pts"))
def trend_lag(spark, sf_dir):
    return C.trend(_points(spark, sf_dir), "rule_id", "iteration", "failures")


@query(
    with_(
        _POINTS_SQL,
        """select rule_id, coalesce(max(failures) filter (where iteration = (select min(iteration) from pts)), 0)::bigint as first, coalesce(max(failures) filter (where iteration = (select max(iteration) from pts)), 0)::bigint as last,
  coalesce(max(failures) filter (where iteration = (select max(iteration) from pts)), 0)::bigint - coalesce(max(failures) filter (where iteration = (select min(iteration) from pts)), 0)::bigint as change
from pts group by rule_id""",
    )
)
def trend_first_last(spark, sf_dir):
    points = _points(spark, sf_dir)
    return C.first_last(points, "rule_id", "iteration", "failures", points)


@query(
    with_(
        ARMS_SQL,
        """select scenario_id, first_seen, last_seen, iterations, occurrences, case when last_seen < (select max(iteration) from cases) then 'resolved' when first_seen = (select max(iteration) from cases) then 'new' else 'recurring' end as status
from (select scenario_id, min(iteration) as first_seen, max(iteration) as last_seen, count(distinct iteration)::bigint as iterations, count(*)::bigint as occurrences from cases group by scenario_id)""",
    )
)
def ledger_status(spark, sf_dir):
    return C.ledger_status(cases(spark, sf_dir), "scenario_id", "iteration")


@query(
    with_(
        ARMS_SQL,
        """select scenario_id, (count(*) - coalesce(max(rn) filter (where not ok), 0))::bigint as tail
from (select scenario_id, row_number() over (partition by scenario_id order by o_orderkey) as rn, price < 200000 as ok from cases) group by scenario_id""",
    )
)
def consecutive_tail(spark, sf_dir):
    return C.consecutive_tail(cases(spark, sf_dir), "scenario_id", "o_orderkey", F.col("price") < 200000)


GATE = {"enough_runs": ("runs", "min", 10), "pass_rate": ("pass_rate", "min", 0.01), "average_score": ("average_score", "min", 20), "worst": ("min_score", "max", 50)}


@query(
    with_(
        SCORES_SQL
        + """,
m as (select task_family, count(*)::double as runs, round(count(*) filter (where passed)::double / count(*), 4) as pass_rate, round(sum(score)::double / count(*), 2) as average_score, min(score)::double as min_score from scores group by task_family),
ch as (select task_family, unnest([{check_id: 'enough_runs', actual: runs, kind: 'min', bound: 10::double, passed: runs >= 10}, {check_id: 'pass_rate', actual: pass_rate, kind: 'min', bound: 0.01::double, passed: pass_rate >= 0.01},
  {check_id: 'average_score', actual: average_score, kind: 'min', bound: 20::double, passed: average_score >= 20}, {check_id: 'worst', actual: min_score, kind: 'max', bound: 50::double, passed: min_score <= 50}], recursive := true) from m)""",
        "select *, bool_and(passed) over (partition by task_family) as gate_passed from ch",
    )
)
def gate_checks(spark, sf_dir):
    """The suite gate with a sub-gate for each family."""
    return C.gate_checks(suite(scores(spark, sf_dir)).filter("all_families = 0"), GATE, ("task_family",))


@query(
    with_(
        ARMS_SQL,
        """select scenario_id, case when b is null or c is null then 'unverified' when b = c then 'matched' else 'drifted' end as drift
from (select scenario_id, max(status) filter (where arm = 0) as b, max(status) filter (where arm = 1) as c from cases group by scenario_id)""",
    )
)
def contract_drift(spark, sf_dir):
    rows = cases(spark, sf_dir).groupBy("scenario_id").agg(F.max(F.when(F.col("arm") == 0, F.col("status"))).alias("b"), F.max(F.when(F.col("arm") == 1, F.col("status"))).alias("c"))
    return rows.select("scenario_id", C.contract_drift(rows, "b", "c").alias("drift"))


@query(
    with_(
        ARMS_SQL,
        """select coalesce(l.scenario_id, r.scenario_id) as scenario_id, case when r.scenario_id is null then 'missing' when l.scenario_id is null then 'unexpected' else 'fingerprint_mismatch' end as problem
from (select scenario_id, sha256(score::varchar) as fp from arm where arm = 0) l full join (select scenario_id, sha256(score::varchar) as fp from arm where arm = 1) r on l.scenario_id = r.scenario_id
where l.fp is null or r.fp is null or l.fp <> r.fp""",
    )
)
def heldout_set_equality(spark, sf_dir):
    left, right = (a.select("scenario_id", F.sha2(F.col("score").cast("string"), 256).alias("fingerprint")) for a in arms(spark, sf_dir))
    return C.set_equality(left, right, "scenario_id")


@query(with_(ARMS_SQL, "select family, status as value, count(*)::bigint as n from cases group by family, status"))
def family_value_counts(spark, sf_dir):
    return cases(spark, sf_dir).groupBy("family", F.col("status").alias("value")).agg(F.count("*").alias("n"))


@query(with_(ARMS_SQL, "select status, count(distinct scenario_id)::bigint as scenarios, count(*)::bigint as n from cases group by status order by n desc, status"))
def decision_counts(spark, sf_dir):
    return cases(spark, sf_dir).groupBy("status").agg(F.count_distinct("scenario_id").alias("scenarios"), F.count("*").alias("n"))
