"""Queries over evaluation statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from runloom.operators import evaluation as E
from runloom.plans.comparison import ARMS_SQL, arms, cases
from runloom.plans.registry import query, with_
from runloom.session import load

REVIEW_SQL = """
rev as (
  select d.doc_id, d.lang as family, case when l.toxic = 1 then 'unsafe' when l.quality = 1 then 'accept' else 'reject' end as human_label,
         least(100, d.n_chars // 20)::bigint as score, d.n_chars >= 1200 as passed
  from labels l join documents d on l.doc_id = d.doc_id)"""


def reviewed(spark, sf_dir):
    label = F.when(F.col("toxic") == 1, "unsafe").when(F.col("quality") == 1, "accept").otherwise("reject")
    rows = load(spark, sf_dir, "labels").join(load(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars"), "doc_id")
    return rows.select("doc_id", F.col("lang").alias("family"), label.alias("human_label"), F.least(F.lit(100), F.floor(F.col("n_chars") / 20)).cast("long").alias("score"), (F.col("n_chars") >= 1200).alias("passed"))


@query(
    with_(
        REVIEW_SQL,
        """select count(*)::bigint as reviewed, count(*)::bigint as comparable, count(*) filter (where (human_label = 'accept') = passed)::bigint as agreements,
  count(*) filter (where passed and human_label <> 'accept')::bigint as false_positives, count(*) filter (where not passed and human_label = 'accept')::bigint as false_negatives,
  round(count(*) filter (where (human_label = 'accept') = passed)::double / count(*), 4) as agreement_rate from rev""",
    )
)
def calibration_confusion(spark, sf_dir):
    return E.confusion(reviewed(spark, sf_dir))


@query(
    with_(
        REVIEW_SQL,
        """select t.human_label, count(rev.doc_id)::bigint as n, round(sum(score)::double / nullif(count(score), 0), 2) as mean_score
from (select unnest(['accept', 'reject', 'needs_review', 'unsafe', 'incomplete']) as human_label) t left join rev on rev.human_label = t.human_label group by t.human_label""",
    )
)
def label_counts(spark, sf_dir):
    return E.label_counts(reviewed(spark, sf_dir), ["accept", "reject", "needs_review", "unsafe", "incomplete"])


@query(
    """select event_type, quantile_cont(v, 0.5) as p50, quantile_disc(v, 0.95) as p95, count(v)::bigint as known, (count(*) - count(v))::bigint as missing, round(sum(v), 2) as total
from (select event_type, case when event_id % 7 <> 0 then round(value, 2) end as v from events) group by event_type"""
)
def latency_percentiles(spark, sf_dir):
    rows = load(spark, sf_dir, "events").select("event_type", F.when(F.col("event_id") % 7 != 0, F.round("value", 2)).alias("v"))
    return E.latency(rows, "event_type", "v")


@query("select p_brand, round(coalesce(pow(sum(p_size), 2) / nullif(sum(p_size * p_size), 0), 0), 6)::double as effective_sample_size from part group by p_brand")
def effective_sample_size(spark, sf_dir):
    return E.effective_sample_size(load(spark, sf_dir, "part").withColumn("w", F.col("p_size").cast("double")), "p_brand", "w")


@query(with_(ARMS_SQL, "select scenario_id, family, count(distinct arm)::bigint as arms, count(*)::bigint as n from cases where iteration >= 1995 group by scenario_id, family having count(distinct arm) <> 2 or count(*) <> 2"))
def pair_key_equality(spark, sf_dir):
    return E.pair_keys(cases(spark, sf_dir).filter("iteration >= 1995"), ["scenario_id", "family"], "arm", 2)


@query(with_(ARMS_SQL, "select scenario_id, count(distinct (arm, iteration))::bigint as repeats from cases group by scenario_id"))
def repeat_coverage(spark, sf_dir):
    return E.coverage(cases(spark, sf_dir), "scenario_id", ["arm", "iteration"])


_BOTH_SQL = ARMS_SQL + ", both_arms as (select b.scenario_id, b.scenario_id % 9 as family, b.passed as b_passed, c.passed as c_passed, b.score::double as b_cost, c.score::double as c_cost, (c.score - b.score)::double as delta from arm b join arm c on b.scenario_id = c.scenario_id and b.arm = 0 and c.arm = 1)"


def _both(spark, sf_dir):
    b, c = arms(spark, sf_dir)
    b, c = b.toDF("scenario_id", "b_score", "b_passed"), c.toDF("scenario_id", "c_score", "c_passed")
    d = lambda x: F.col(x).cast("double")
    return b.join(c, "scenario_id").select("scenario_id", (F.col("scenario_id") % 9).alias("family"), "b_passed", "c_passed", d("b_score").alias("b_cost"), d("c_score").alias("c_cost"), (d("c_score") - d("b_score")).alias("delta"))


@query(
    with_(
        _BOTH_SQL,
        """select *, candidate_rate < baseline_rate - 0.02 as regressed from (select family, count(*)::bigint as pairs, round(avg(b_passed::integer), 6) as baseline_rate, round(avg(c_passed::integer), 6) as candidate_rate,
  count(*) filter (where b_passed and not c_passed)::bigint as new_failures, round(avg(b_cost), 4) as baseline_cost, round(avg(c_cost), 4) as candidate_cost from both_arms group by family)""",
    )
)
def non_regression_groups(spark, sf_dir):
    return E.non_regression(_both(spark, sf_dir), "family", 0.02)


@query(with_(_BOTH_SQL, "select scenario_id % 50 as cluster, avg(delta) as mean_delta, count(*)::bigint as repeats from both_arms group by all"))
def cluster_means(spark, sf_dir):
    return E.cluster_means(_both(spark, sf_dir).withColumn("cluster", F.col("scenario_id") % 50), ["cluster"], "delta")


@query()
def paired_bootstrap(spark, sf_dir):
    """Interval of the mean difference, by resampled clusters; tested against a plain version."""
    return E.bootstrap(cluster_means(spark, sf_dir), "cluster")


@query()
def stratified_bootstrap(spark, sf_dir):
    return E.bootstrap(cluster_means(spark, sf_dir).withColumn("domain", F.col("cluster") % 4), "cluster", strata="domain")


@query(with_(_BOTH_SQL, "select family, round(avg(m), 6) as macro, count(*)::bigint as groups from (select family, scenario_id % 4 as domain, avg(c_cost) as m from both_arms group by all) group by family"))
def macro_average(spark, sf_dir):
    return E.macro_average(_both(spark, sf_dir).withColumn("domain", F.col("scenario_id") % 4), ["family"], "domain", "c_cost")


_SYNONYMS = {"o": "passed", "f": "failed", "p": "error"}


@query(
    """select o_custkey, case when count(outcome) = 0 then 'unavailable' when count(*) filter (where outcome in ('error', 'skipped')) > 0 then 'error' when count(*) filter (where outcome = 'failed') > 0 then 'failed' else 'passed' end as outcome,
  round(avg(o_totalprice), 6) as mean_score
from (select o_custkey, o_totalprice, case when o_orderkey % 3 = 0 then null when o_orderstatus = 'O' then 'passed' when o_orderstatus = 'F' then 'failed' when o_orderstatus = 'P' then 'error' end as outcome from orders) group by o_custkey"""
)
def outcome_precedence(spark, sf_dir):
    raw = F.when(F.col("o_orderkey") % 3 != 0, F.concat(F.lit(" "), F.col("o_orderstatus")))
    rows = load(spark, sf_dir, "orders").select("o_custkey", "o_totalprice", E.normalise_outcome(raw, _SYNONYMS).alias("outcome"))
    return E.outcome_precedence(rows, "o_custkey", "outcome", "o_totalprice")


@query("select n_name, greatest(count(c_custkey), 1)::bigint as trials, count(*) filter (where c_acctbal > 5000)::bigint as passed, round(count(*) filter (where c_acctbal > 5000)::double / greatest(count(c_custkey), 1), 6) as rate from nation left join customer on n_nationkey = c_nationkey and c_mktsegment = 'BUILDING' group by n_name")
def behaviour_rates(spark, sf_dir):
    nation = load(spark, sf_dir, "nation")
    trials = load(spark, sf_dir, "customer").filter("c_mktsegment = 'BUILDING'").join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey")).select("n_name", (F.col("c_acctbal") > 5000).alias("ok_"))
    return E.behaviour_rates(nation, trials, "n_name", "ok_")


@query(
    with_(
        ARMS_SQL,
        "select scenario_id, o_orderkey, price, incumbent, coalesce(price > incumbent, true) as kept from (select *, max(price) over (partition by scenario_id order by o_orderkey rows between unbounded preceding and 1 preceding) as incumbent from cases)",
    )
)
def incumbent_running_max(spark, sf_dir):
    return E.running_best(cases(spark, sf_dir), "scenario_id", "o_orderkey", "price").select("scenario_id", "o_orderkey", "price", "incumbent", "kept")


@query(
    with_(
        ARMS_SQL,
        "select scenario_id, len(have)::bigint as arms, array_to_string(list_sort(list_filter([0, 1, 2, 3, 4], lambda x: not list_contains(have, x))), ',') as missing from (select scenario_id, list(distinct family) as have from cases group by scenario_id)",
    )
)
def arm_scenario_sets(spark, sf_dir):
    return E.set_membership(cases(spark, sf_dir), "scenario_id", "family", [0, 1, 2, 3, 4])
