"""Comparing arms and iterations, ledgers, and gates."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, Window, functions as F


def compare_suites(baseline: DataFrame, candidate: DataFrame, key: str = "scenario_id") -> DataFrame:
    """Full outer comparison of (key, score, passed): movement of each scenario; one that the candidate lacks is a regression."""
    b, c = baseline.alias("b"), candidate.alias("c")
    both = b.join(c, F.col(f"b.{key}") == F.col(f"c.{key}"), "full_outer")
    status = (
        F.when(F.col(f"c.{key}").isNull(), "missing").when(F.col(f"b.{key}").isNull(), "new")
        .when(F.col("b.passed") & ~F.col("c.passed"), "regressed").when(~F.col("b.passed") & F.col("c.passed"), "fixed").otherwise("unchanged")
    )
    return both.select(
        F.coalesce(f"b.{key}", f"c.{key}").alias(key), status.alias("status"), F.col("b.score").alias("baseline_score"), F.col("c.score").alias("candidate_score"),
        (F.col("c.score") - F.col("b.score")).alias("score_delta"), status.isin("missing", "regressed").alias("regression"),
    )


def compare_rules(baseline: DataFrame, candidate: DataFrame, *keys: str) -> DataFrame:
    """Rule by rule: fixed, regressed or unchanged; a rule on one side only is unchanged."""
    b, c = baseline.alias("b"), candidate.alias("c")
    same = F.lit(True)
    for k in keys:
        same = same & (F.col(f"b.{k}") == F.col(f"c.{k}"))
    change = F.when(F.col("b.passed") & ~F.col("c.passed"), "regressed").when(~F.col("b.passed") & F.col("c.passed"), "fixed").otherwise("unchanged")
    return b.join(c, same, "full_outer").select(*[F.coalesce(f"b.{k}", f"c.{k}").alias(k) for k in keys], change.alias("change"))


def failure_deltas(baseline: DataFrame, candidate: DataFrame, rule: str = "rule_id") -> DataFrame:
    """Failures of each rule before and after."""
    sides = baseline.select(rule, "passed", F.lit(0).alias("side")).unionAll(candidate.select(rule, "passed", F.lit(1).alias("side")))
    failed = ~F.col("passed")
    rows = sides.groupBy(rule).agg(F.count_if(failed & (F.col("side") == 0)).alias("before"), F.count_if(failed & (F.col("side") == 1)).alias("after"))
    return rows.filter("before > 0 or after > 0").withColumn("delta", F.col("after") - F.col("before"))


def pair_rows(baseline: DataFrame, candidate: DataFrame, min_gap: int, key: str = "scenario_id") -> DataFrame:
    """Preference pairs between arms: the side of the higher score is chosen where the scores differ by ``min_gap`` at least."""
    b, c = baseline.alias("b"), candidate.alias("c")
    both = b.join(c, F.col(f"b.{key}") == F.col(f"c.{key}"))
    delta = F.col("c.score") - F.col("b.score")
    return both.filter(F.abs(delta) >= min_gap).select(F.col(f"b.{key}").alias(key), delta.alias("candidate_score_delta"), F.abs(delta).alias("score_gap"), F.when(delta > 0, "candidate").otherwise("baseline").alias("chosen_side"))


def movement(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("chosen_side").agg(F.count_distinct("scenario_id").alias("scenarios"), F.sum("score_gap").cast("long").alias("total_gap"))


def trend(points: DataFrame, series: str, at: str, value: str) -> DataFrame:
    """Each point's change from the one before; null for the first."""
    return points.withColumn("delta", F.col(value) - F.lag(value).over(Window.partitionBy(series).orderBy(at)))


def first_last(points: DataFrame, series: str, at: str, value: str, domain: DataFrame) -> DataFrame:
    """First and last value of each series over all points of ``domain``; a point without a value counts as 0."""
    ends = domain.agg(F.min(at).alias("lo"), F.max(at).alias("hi"))
    rows = points.crossJoin(F.broadcast(ends))  # one row
    pick = lambda end: F.coalesce(F.max(F.when(F.col(at) == F.col(end), F.col(value))), F.lit(0)).cast("long")
    return rows.groupBy(series).agg(pick("lo").alias("first"), pick("hi").alias("last")).withColumn("change", F.col("last") - F.col("first"))


def ledger_status(occurrences: DataFrame, key: str, iteration: str) -> DataFrame:
    """new, recurring or resolved, by the iterations that a key occurs in against the latest of all."""
    latest = occurrences.agg(F.max(iteration).alias("latest"))
    rows = occurrences.groupBy(key).agg(F.min(iteration).alias("first_seen"), F.max(iteration).alias("last_seen"), F.count_distinct(iteration).alias("iterations"), F.count("*").alias("occurrences"))
    status = F.when(F.col("last_seen") < F.col("latest"), "resolved").when(F.col("first_seen") == F.col("latest"), "new").otherwise("recurring")
    return rows.crossJoin(F.broadcast(latest)).select(key, "first_seen", "last_seen", "iterations", "occurrences", status.alias("status"))


def consecutive_tail(decisions: DataFrame, group: str, order: str, flag: Column) -> DataFrame:
    """How many of a group's last decisions in a row meet the flag."""
    w = Window.partitionBy(group)
    rows = decisions.select(group, F.row_number().over(w.orderBy(order)).alias("rn"), F.coalesce(flag, F.lit(False)).alias("ok"))
    return rows.groupBy(group).agg((F.count("*") - F.coalesce(F.max(F.when(~F.col("ok"), F.col("rn"))), F.lit(0))).cast("long").alias("tail"))


def gate_checks(metrics: DataFrame, policy: Mapping[str, tuple[str, str, Any]], keys: tuple[str, ...] = ()) -> DataFrame:
    """Checks of a metrics row against a policy: ``{check id: (metric, 'min' | 'max' | 'equals', bound)}``.

    One row a check, with the gate's overall decision on each; a null metric
    fails its check. One operator serves every gate: suite, export, compare,
    reviewed, ledgers, calibration, observability, promotion.
    """
    rows = []
    for check, (metric, kind, bound) in policy.items():
        actual = F.col(metric).cast("double")
        ok = actual >= bound if kind == "min" else actual <= bound if kind == "max" else actual == bound
        rows.append(F.struct(F.lit(check).alias("check_id"), actual.alias("actual"), F.lit(kind).alias("kind"), F.lit(float(bound)).alias("bound"), F.coalesce(ok, F.lit(False)).alias("passed")))
    checks = metrics.select(*keys, F.array(*rows).alias("checks"))
    return checks.select(*keys, F.forall("checks", lambda c: c["passed"]).alias("gate_passed"), F.inline("checks"))


def contract_drift(rows: DataFrame, before: str, after: str) -> Column:
    """matched, drifted, or unverified where a hash is missing."""
    return F.when(F.col(before).isNull() | F.col(after).isNull(), "unverified").when(F.col(before) == F.col(after), "matched").otherwise("drifted")


def set_equality(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys of either side that the other lacks, and keys whose fingerprints differ; each row names its problem."""
    both = left.alias("l").join(right.alias("r"), F.col(f"l.{key}") == F.col(f"r.{key}"), "full_outer")
    problem = F.when(F.col(f"r.{key}").isNull(), "missing").when(F.col(f"l.{key}").isNull(), "unexpected").when(F.col("l.fingerprint") != F.col("r.fingerprint"), "fingerprint_mismatch")
    return both.select(F.coalesce(f"l.{key}", f"r.{key}").alias(key), problem.alias("problem")).filter("problem is not null")
