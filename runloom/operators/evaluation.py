"""Evaluation statistics: pairing, coverage, non-regression, intervals, calibration."""

from __future__ import annotations

import hashlib
import math
import random
from collections.abc import Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F


def confusion(reviewed: DataFrame, passed: str = "passed", label: str = "human_label", positive: tuple[str, ...] = ("accept",), negative: tuple[str, ...] = ("reject", "unsafe", "incomplete")) -> DataFrame:
    """Agreement of scorecards with human labels; labels outside both sets are not comparable."""
    human, card = F.col(label).isin(*positive), F.coalesce(F.col(passed), F.lit(False))
    comparable = F.col(label).isin(*positive, *negative)
    return reviewed.agg(
        F.count("*").alias("reviewed"),
        F.count_if(comparable).alias("comparable"),
        F.count_if(comparable & (human == card)).alias("agreements"),
        F.count_if(comparable & card & ~human).alias("false_positives"),
        F.count_if(comparable & ~card & human).alias("false_negatives"),
        F.round(F.count_if(comparable & (human == card)) / F.nullif(F.count_if(comparable), F.lit(0)), 4).alias("agreement_rate"),
    )


def label_counts(reviewed: DataFrame, domain: list[str], label: str = "human_label", score: str = "score") -> DataFrame:
    """Count and mean score of every label of the domain, zero and null where none has it."""
    every = reviewed.sparkSession.createDataFrame([(x,) for x in domain], f"{label} string")
    rows = reviewed.groupBy(label).agg(F.count("*").alias("n"), F.round(F.sum(score).cast("double") / F.count(score), 2).alias("mean_score"))
    return every.join(rows, label, "left").select(label, F.coalesce("n", F.lit(0)).cast("long").alias("n"), "mean_score")


def latency(cases: DataFrame, group: str, value: str) -> DataFrame:
    """Median (mean of the middle two), nearest-rank 95th percentile, known and missing values and their sum."""
    return cases.groupBy(group).agg(
        F.expr(f"percentile_cont(0.5) within group (order by {value})").alias("p50"),
        F.expr(f"percentile_disc(0.95) within group (order by {value})").alias("p95"),
        F.count(value).alias("known"),
        (F.count("*") - F.count(value)).alias("missing"),
        F.round(F.sum(value), 2).alias("total"),
    )


def effective_sample_size(rows: DataFrame, group: str, weight: str) -> DataFrame:
    w = F.greatest(F.col(weight), F.lit(0.0))
    return rows.groupBy(group).agg(F.round(F.coalesce(F.sum(w) * F.sum(w) / F.nullif(F.sum(w * w), F.lit(0.0)), F.lit(0.0)), 6).alias("effective_sample_size"))


def pair_keys(cases: DataFrame, keys: list[str], arm: str, arms: int) -> DataFrame:
    """Keys that not every arm has exactly once: the pairing holds when there is none."""
    rows = cases.groupBy(*keys).agg(F.count_distinct(arm).alias("arms"), F.count("*").alias("n"))
    return rows.filter((F.col("arms") != arms) | (F.col("n") != arms))


def coverage(cases: DataFrame, scenario: str, repeat: list[str]) -> DataFrame:
    """Distinct repeats of each scenario."""
    return cases.groupBy(scenario).agg(F.count_distinct(F.struct(*repeat)).alias("repeats"))


def non_regression(pairs: DataFrame, group: str, tolerance: float) -> DataFrame:
    """Per group: pass rates of both arms and whether the candidate's is lower by more than the tolerance.

    ``pairs`` has b_passed, c_passed, b_cost, c_cost.
    """
    rows = pairs.groupBy(group).agg(
        F.count("*").alias("pairs"),
        F.round(F.avg(F.col("b_passed").cast("int")), 6).alias("baseline_rate"),
        F.round(F.avg(F.col("c_passed").cast("int")), 6).alias("candidate_rate"),
        F.count_if(F.col("b_passed") & ~F.col("c_passed")).alias("new_failures"),
        F.round(F.avg("b_cost"), 4).alias("baseline_cost"),
        F.round(F.avg("c_cost"), 4).alias("candidate_cost"),
    )
    return rows.withColumn("regressed", F.col("candidate_rate") < F.col("baseline_rate") - tolerance)


def cluster_means(pairs: DataFrame, cluster: list[str], delta: str) -> DataFrame:
    """Mean difference of each cluster's repeats; clusters are the units that are resampled."""
    return pairs.groupBy(*cluster).agg(F.avg(delta).alias("mean_delta"), F.count("*").alias("repeats"))


def bootstrap(clusters: DataFrame, key: str, value: str = "mean_delta", strata: str | None = None, samples: int = 2000, seed: int = 17, level: float = 0.95) -> DataFrame:
    """Percentile interval of the mean over resampled clusters, and the effect size.

    ``clusters`` has one row a scenario cluster. They are put in order of their
    hashed key and resampled by Python's seeded generator, so results repeat bit
    for bit. With ``strata`` clusters are drawn inside each stratum and the
    statistic is the mean of the strata's means.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.assign(h=[hashlib.sha256(str(k).encode()).hexdigest() for k in pdf[key]]).sort_values(["h", key])
        groups = [g[value].tolist() for _, g in pdf.groupby(strata, sort=True)] if strata else [pdf[value].tolist()]
        rng = random.Random(seed)

        def mean(x: list[float]) -> float:
            return math.fsum(x) / len(x)

        draws = sorted(mean([mean([g[rng.randrange(len(g))] for _ in g]) for g in groups]) for _ in range(samples))
        tail = (1 - level) / 2
        values = [v for g in groups for v in g]
        center = mean([mean(g) for g in groups])
        spread = math.sqrt(math.fsum((v - mean(values)) ** 2 for v in values) / (len(values) - 1)) if len(values) > 1 else 0.0
        out = {"n": [len(values)], "mean": [center], "lower": [draws[math.floor(tail * (samples - 1))]], "upper": [draws[math.ceil((1 - tail) * (samples - 1))]], "effect": [center / spread if spread else 0.0]}
        return pd.DataFrame(out)

    columns = [key, value] + ([strata] if strata else [])
    one = clusters.select(*columns).withColumn("__all", F.lit(1))
    return one.groupBy("__all").applyInPandas(lambda pdf: run(pdf), "n long, mean double, lower double, upper double, effect double")


def macro_average(rows: DataFrame, group: list[str], inner: str, value: str) -> DataFrame:
    """Mean over ``inner`` groups of their means."""
    means = rows.groupBy(*group, inner).agg(F.avg(value).alias("m"))
    return means.groupBy(*group).agg(F.round(F.avg("m"), 6).alias("macro"), F.count("*").alias("groups"))


def normalise_outcome(outcome: Column, synonyms: Mapping[str, str]) -> Column:
    """passed, failed, error or skipped; null where the outcome is none of the synonyms."""
    table = F.create_map(*[F.lit(x) for pair in synonyms.items() for x in pair])
    return F.try_element_at(table, F.lower(F.trim(outcome)))


def outcome_precedence(cases: DataFrame, group: str, outcome: str, score: str) -> DataFrame:
    """One outcome a group: unavailable if it has none, else error or skipped, else failed, else passed; mean of finite scores."""
    has = lambda *x: F.count_if(F.col(outcome).isin(*x)) > 0
    finite = F.when(~F.isnan(score) & (F.abs(score) < float("inf")), F.col(score))
    return cases.groupBy(group).agg(
        F.when(F.count(outcome) == 0, "unavailable").when(has("error", "skipped"), "error").when(has("failed"), "failed").otherwise("passed").alias("outcome"), F.round(F.avg(finite), 6).alias("mean_score")
    )


def behaviour_rates(domain: DataFrame, trials: DataFrame, family: str, passed: str) -> DataFrame:
    """Pass rate of every family of the domain; one without trials counts as one failed trial."""
    rows = domain.select(family).distinct().join(trials, family, "left").withColumn("ok", F.coalesce(passed, F.lit(False)))
    return rows.groupBy(family).agg(F.count("*").alias("trials"), F.count_if("ok").alias("passed"), F.round(F.avg(F.col("ok").cast("int")), 6).alias("rate"))


def running_best(rows: DataFrame, group: str, order: str, value: str) -> DataFrame:
    """Keep-or-discard: a row is kept if it beats all rows before it."""
    before = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    best = F.max(value).over(before)
    return rows.withColumn("incumbent", best).withColumn("kept", F.coalesce(F.col(value) > best, F.lit(True)))


def set_membership(cases: DataFrame, key: str, arm: str, arms: list) -> DataFrame:
    """Which arms lack each key; a key is shared when none does."""
    rows = cases.groupBy(key).agg(F.collect_set(arm).alias("have"))
    return rows.select(key, F.size("have").cast("long").alias("arms"), F.array_join(F.sort_array(F.array_except(F.array(*[F.lit(a) for a in arms]), "have")).cast("array<string>"), ",").alias("missing"))
