"""Gates: policies of thresholds, lists and families over measured rows; evidence that a decision needs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

#: The scope of checks that are over all rows.
WHOLE = "*"
CHECK = "scope string, check_id string, name string, kind string, bound double"


def checks_of(policy: Mapping[str, float | Sequence[str]], scope: str = WHOLE) -> list[tuple]:
    """Rows of ``CHECK`` from a policy: ``min_x``, ``max_x`` and ``equal_x`` bound the measure x, ``forbid_x`` and ``require_x`` list values of x."""
    out: list[tuple] = []
    for field, value in policy.items():
        kind, _, name = field.partition("_")
        if kind in ("min", "max", "equal"):
            out.append((scope, field, name, kind, float(value)))
        elif kind in ("forbid", "require"):
            out += [(scope, f"{field}:{v}", f"{name}:{v}", kind, 0.0) for v in value]
        else:
            raise ValueError(f"unknown field of a policy: {field}")
    return out


def evaluate(spark: SparkSession, measures: DataFrame, checks: list[tuple]) -> DataFrame:
    """``(scope, check_id, actual, bound, passed, gate_passed)``: a row for each check of the policy.

    ``measures`` has (scope, name, value); list checks look at the measure
    ``x:value``, whose absence counts as 0. A bounded measure that is missing
    fails its check, as does a scope without any measure.
    """
    policy = spark.createDataFrame(checks, CHECK)  # a row for each field of a policy
    listed = F.col("kind").isin("forbid", "require")
    actual = F.when(listed, F.coalesce("value", F.lit(0.0))).otherwise(F.col("value"))
    ok = (
        F.when(F.col("kind") == "min", F.col("actual") >= F.col("bound")).when(F.col("kind") == "max", F.col("actual") <= F.col("bound"))
        .when(F.col("kind") == "equal", F.col("actual") == F.col("bound")).when(F.col("kind") == "forbid", F.col("actual") == 0).otherwise(F.col("actual") > 0)
    )
    rows = policy.join(measures, ["scope", "name"], "left").select("scope", "check_id", "kind", "bound", actual.alias("actual"))
    judged = rows.select("scope", "check_id", "actual", "bound", F.coalesce(ok, F.lit(False)).alias("passed"))
    return judged.withColumn("gate_passed", F.bool_and("passed").over(Window.partitionBy(F.lit(0))))  # a row for each check


def measures_of(rows: DataFrame, scope: Column, **measures: Column) -> DataFrame:
    """``(scope, name, value)`` of aggregates over each scope and over all rows, in one pass by grouping sets."""
    keyed = rows.withColumn("__scope", scope)
    wide = keyed.groupingSets([["__scope"], []], "__scope").agg(F.grouping("__scope").alias("__all"), *[m.cast("double").alias(n) for n, m in measures.items()])
    wide = wide.select(F.when(F.col("__all") == 1, WHOLE).otherwise(F.col("__scope")).alias("scope"), *measures)
    return wide.unpivot("scope", list(measures), "name", "value")


def counts_of(rows: DataFrame, scope: Column, name: str, value: str) -> DataFrame:
    """``(scope, name, value)``: how often each value occurs in each scope and over all rows."""
    keyed = rows.withColumn("__scope", scope).filter(F.col(value).isNotNull())
    sums = keyed.groupingSets([["__scope", value], [value]], "__scope", value).agg(F.grouping("__scope").alias("__all"), F.count("*").cast("double").alias("value"))
    return sums.select(F.when(F.col("__all") == 1, WHOLE).otherwise(F.col("__scope")).alias("scope"), F.concat(F.lit(f"{name}:"), F.col(value).cast("string")).alias("name"), "value")


def suite_gate(cards: DataFrame, rules: DataFrame, policy: Mapping, families: Mapping[str, Mapping] | None = None) -> DataFrame:
    """Gate over a suite's cards (task_family, score, passed) and rules (task_family, rule_id, passed, critical), with sub-gates of families."""
    n = F.count("*")
    scope = F.col("task_family")
    measured = measures_of(cards, scope, pass_rate=F.round(F.count_if("passed") / n, 4), average_score=F.round(F.avg("score"), 2), failed=F.count_if(~F.col("passed")))
    failed = rules.filter("not passed")
    critical = failed.filter("critical")
    totals = measures_of(cards.select("task_family", F.lit(0).alias("x")).unionAll(critical.select("task_family", F.lit(1))), scope, critical_failures=F.sum("x"))
    every = measured.unionAll(totals).unionAll(counts_of(failed, scope, "failed_rules", "rule_id")).unionAll(counts_of(critical, scope, "critical_rules", "rule_id"))
    checks = checks_of(policy) + [c for family, own in (families or {}).items() for c in checks_of(own, family)]
    return evaluate(cards.sparkSession, every, checks)


def list_gate(rows: DataFrame, policy: Mapping, **columns: str) -> DataFrame:
    """Gate of counts and of forbidden and required values; ``columns`` names the column of each list."""
    totals = rows.agg(F.count("*").cast("double").alias("rows"), *[F.count_distinct(c).cast("double").alias(f"distinct_{n}") for n, c in columns.items()])
    names = totals.columns
    measured = totals.withColumn("scope", F.lit(WHOLE)).unpivot("scope", names, "name", "value")
    # All lists in one aggregate, which combines before its shuffle.
    seen = rows.select(F.explode(F.array(*[F.concat(F.lit(f"{n}:"), F.col(c).cast("string")) for n, c in columns.items()])).alias("name")).filter("name is not null")
    listed = seen.groupBy("name").agg(F.count("*").cast("double").alias("value")).select(F.lit(WHOLE).alias("scope"), "name", "value")
    return evaluate(rows.sparkSession, measured.unionAll(listed), checks_of(policy))


def evidence_gate(refs: DataFrame, group: str, required: Sequence[str]) -> DataFrame:
    """``(group, check_id, present, passing, passed, decision)``: each required kind of evidence must be there and all of it must pass.

    ``refs`` has (group, kind, passed); the decision is ``promote`` or ``block``
    for a group as a whole. It serves promotion decisions and the admission of
    sampled rows alike.
    """
    kinds = F.array(*map(F.lit, required))
    counts = refs.filter(F.col("kind").isin(*required)).groupBy(group, "kind").agg(F.count("*").alias("present"), F.count_if("passed").alias("passing"))
    every = refs.select(group).distinct().select(group, F.explode(kinds).alias("kind"))
    rows = every.join(counts, [group, "kind"], "left").select(
        group, F.concat("kind", F.lit("_present_and_passing")).alias("check_id"), F.coalesce("present", F.lit(0)).alias("present"), F.coalesce("passing", F.lit(0)).alias("passing"),
        F.coalesce((F.col("present") > 0) & (F.col("present") == F.col("passing")), F.lit(False)).alias("passed"),
    )
    decided = rows.groupBy(group).agg(F.when(F.bool_and("passed"), "promote").otherwise("block").alias("decision"))
    return rows.join(decided, group)


def three_arms(cases: DataFrame, arms: tuple[str, str, str]) -> DataFrame:
    """``(check_id, candidate, reference, comparable, passed)``: the last arm against each of the others.

    ``cases`` has (arm, scenario_id, fingerprint, passed, score, critical). The
    comparisons count only where all arms ran the same scenarios with the same
    content; then pass rate and mean score must be higher and critical failures fewer.
    """
    held = cases.filter(F.col("arm").isin(*arms))
    sets = held.groupBy("scenario_id").agg(F.count_distinct("arm").alias("arms"), F.count_distinct("fingerprint").alias("contents"))
    same = sets.agg((F.coalesce(F.bool_and((F.col("arms") == len(arms)) & (F.col("contents") == 1)), F.lit(False))).alias("comparable"))
    by = held.groupBy("arm").agg(F.round(F.avg(F.col("passed").cast("double")), 6).alias("pass_rate"), F.round(F.avg("score"), 6).alias("average_score"), F.sum(F.col("critical").cast("double")).alias("critical_failures"))
    long = by.unpivot("arm", ["pass_rate", "average_score", "critical_failures"], "measure", "value")
    new, old = long.filter(F.col("arm") == arms[-1]).alias("c"), long.filter(F.col("arm") != arms[-1]).alias("r")
    both = new.join(old, F.col("c.measure") == F.col("r.measure")).crossJoin(F.broadcast(same))  # one row
    word = F.when(F.col("c.measure") == "critical_failures", "fewer_").otherwise("higher_")
    better = F.when(F.col("c.measure") == "critical_failures", F.col("c.value") < F.col("r.value")).otherwise(F.col("c.value") > F.col("r.value"))
    return both.select(
        F.concat(word, F.col("c.measure"), F.lit("_than_"), F.col("r.arm")).alias("check_id"), F.col("c.value").alias("candidate"), F.col("r.value").alias("reference"),
        "comparable", (F.col("comparable") & F.coalesce(better, F.lit(False))).alias("passed"),
    )


def promotion_evidence(cases: DataFrame, arms: tuple[str, str, str], least_repeats: int, least_effect: float) -> DataFrame:
    """``(check_id, actual, passed)`` over cases (arm, pool, scenario_id, repeat, seed, score): arms, pairing, repeats and effect.

    The bootstrap interval of ``evaluation.bootstrap`` adds the uncertainty; these
    are the checks that hold before it is looked at.
    """
    key = ["pool", "scenario_id", "repeat", "seed"]
    held = cases.filter(F.col("arm").isin(*arms))
    present = held.agg(F.count_distinct("arm").alias("n")).select(F.lit("three_required_arms_present").alias("check_id"), F.col("n").cast("double").alias("actual"), (F.col("n") == len(arms)).alias("passed"))
    keys = held.groupBy(*key).agg(F.count_distinct("arm").alias("arms"), F.count("*").alias("n"))
    odd = F.count_if((F.col("arms") != len(arms)) | (F.col("n") != len(arms)))
    paired = keys.agg(odd.alias("odd"), F.count("*").alias("all")).select(F.lit("identical_paired_observations"), F.col("odd").cast("double"), (F.col("odd") == 0) & (F.col("all") > 0))
    repeats = held.groupBy("arm", "pool", "scenario_id").agg(F.count_distinct("repeat", "seed").alias("n")).agg(F.min("n").alias("n"))
    repeats = repeats.select(F.lit("minimum_repeats_per_scenario"), F.col("n").cast("double"), F.coalesce(F.col("n") >= least_repeats, F.lit(False)))
    wide = held.groupBy(*key).agg(*[F.max(F.when(F.col("arm") == a, F.col("score"))).alias(f"s{i}") for i, a in enumerate(arms)])
    out = present.unionAll(paired).unionAll(repeats)
    for i, name in enumerate(arms[:-1]):
        effect = F.round(F.avg(F.col("s2") - F.col(f"s{i}")), 6)
        out = out.unionAll(wide.agg(effect.alias("d")).select(F.lit(f"effect_over_{name}"), "d", F.coalesce(F.col("d") >= least_effect, F.lit(False))))
    return out
