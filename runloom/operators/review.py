"""Reviews, action credit, dataset metrics, repair and planning queues, registries."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from runloom.session import checkpointed


def checked_labels(labels: DataFrame, items: DataFrame, key: str = "item_id") -> DataFrame:
    """Labels with what is wrong with each: no such item, labelled twice, or a stale content hash; unlabelled rows drop out."""
    known = items.select(F.col(key), F.col("item_sha256").alias("__now"), F.lit(True).alias("__there"))
    rows = labels.filter("human_label is not null")
    times = rows.groupBy(key).agg(F.count("*").alias("__times"))
    both = rows.join(times, key).join(known, key, "left")
    problem = F.when(F.col("__there").isNull(), "unknown_item").when(F.col("__times") > 1, "duplicate_label").when(~F.col("item_sha256").eqNullSafe(F.col("__now")), "stale_item")
    return both.withColumn("problem", problem).drop("__now", "__there", "__times")


def reviewed_preferences(labels: DataFrame, cap: int, family: str = "family", contract: str = "contract") -> DataFrame:
    """Accepted rows with negative ones of the same family and contract, in order of ids, ``cap`` pairs a family (the sampler's bound)."""
    good = labels.filter("human_label = 'accept'").select(F.col("row_id").alias("chosen"), family, contract)
    bad = labels.filter("human_label in ('reject', 'unsafe', 'incomplete')").select(F.col("row_id").alias("rejected"), family, contract)
    # The first cap accepted and the first cap rejected of a group hold its first cap pairs.
    top = lambda d, c: d.withColumn("__r", F.row_number().over(Window.partitionBy(family, contract).orderBy(c))).filter(F.col("__r") <= cap).drop("__r")
    pairs = top(good, "chosen").join(top(bad, "rejected"), [family, contract])
    order = Window.partitionBy(family).orderBy(contract, "chosen", "rejected")
    return pairs.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= cap).drop("nth")


def action_credit(calls: DataFrame) -> DataFrame:
    """Label, reward and confidence of each call by the status of its result; a call without one is neutral."""
    status = F.lower(F.coalesce("status", F.lit("")))
    good, bad = status.isin("ok", "success", "completed"), status.isin("error", "failed", "timeout", "denied")
    label = F.when(good, "positive").when(bad, "negative").otherwise("neutral")
    return calls.withColumn("label", label).withColumn("reward", F.when(good, 1.0).when(bad, -1.0).otherwise(0.0)).withColumn("confidence", F.when(good | bad, "high").otherwise("low"))


def call_results(events: DataFrame) -> DataFrame:
    """Calls left-joined to their results by (run, id)."""
    keys = ["run_id", "tool_call_id"]
    calls = events.filter("event_type = 'tool_call' and tool_call_id is not null").select(*keys, "tool_name", F.col("event_index").alias("call_index"))
    results = events.filter("event_type = 'tool_result' and tool_call_id is not null").select(*keys, "status", F.col("event_index").alias("result_index"))
    return calls.join(results, keys, "left")


def dataset_metrics(cards: DataFrame) -> DataFrame:
    """Measures of scored runs in one pass."""
    n = F.count("*")
    return cards.agg(
        n.alias("episodes"), F.count_if("passed").alias("passed"), F.count_if(~F.col("passed")).alias("failed"), F.round(F.avg("score"), 4).alias("average_score"), F.count_distinct("task_family").alias("families"),
        F.count_if(F.col("final_answer").isNull()).alias("without_answer"), F.count_if(F.col("passed") & F.col("final_answer").isNotNull()).alias("eligible"), F.coalesce(F.sum(F.size("failed_rules")), F.lit(0)).cast("long").alias("failed_rules"),
        F.count_if(F.col("completion") == "complete").alias("complete"), F.count_if(F.col("completion") == "incomplete").alias("incomplete"), F.count_if(F.col("completion") == "not_applicable").alias("not_applicable"),
    )


def family_metrics(family: str, artifacts: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of each artifact by family, over the union of all artifacts' families; one shuffle for all."""
    rows = None
    for name, df in artifacts.items():
        one = df.select(F.coalesce(F.col(family), F.lit("unknown")).alias(family), F.lit(name).alias("__a"))
        rows = one if rows is None else rows.unionAll(one)
    return rows.groupBy(family).agg(*[F.count_if(F.col("__a") == name).alias(name) for name in artifacts])


def label_provenance(cards: DataFrame, eligible: DataFrame) -> DataFrame:
    """Passed runs that may not be used as positives."""
    return cards.filter("passed").select("run_id").join(eligible.select("run_id"), "run_id", "left_anti")


def quality_flags(metrics: DataFrame, flags: Mapping[str, Column]) -> DataFrame:
    """Names of the conditions that hold over one row of metrics."""
    return metrics.select(F.array_compact(F.array(*[F.when(c, n) for n, c in flags.items()])).alias("flags"))


def repair_queue(items: DataFrame, events: DataFrame, penalties: Mapping[str, int]) -> DataFrame:
    """One row for each failed rule of a run: priority by penalty, and a snippet of the event it points at."""
    table = F.create_map(*[F.lit(x) for p in penalties.items() for x in p])
    failed = items.select("run_id", F.explode("items").alias("x")).filter(~F.col("x.passed"))
    rules = failed.groupBy("run_id", F.col("x.rule_id").alias("rule_id")).agg(F.count("*").alias("failed_items"), F.min("x.event_index").alias("event_index"))
    texts = events.select("run_id", "event_index", F.substring("text", 1, 60).alias("snippet"))
    rows = rules.join(texts, ["run_id", "event_index"], "left").withColumn("penalty", table[F.col("rule_id")])
    return rows.withColumn("priority", F.when(F.col("penalty") >= 35, "high").when(F.col("penalty") >= 30, "medium").otherwise("low"))


def run_digest(cards: DataFrame, signal: DataFrame) -> DataFrame:
    """Reward to four decimals and the actions that a run's findings call for, in fixed order."""
    both = cards.select("run_id", "score", "passed", "failed_rules").join(signal.select("run_id", "has_final_answer", "tool_call_count", "api_call_count"), "run_id")
    actions = F.array_compact(
        F.array(
            F.when(F.array_contains("failed_rules", "secret_exposure"), "rotate_secret"),
            F.when(F.array_contains("failed_rules", "forbidden_actions"), "review_policy"),
            F.when(~F.col("has_final_answer"), "ask_for_answer"),
            F.when(F.col("tool_call_count") + F.col("api_call_count") == 0, "record_tools"),  # results alone do not count here
            F.when(F.col("passed"), "keep_as_reference"),
        )
    )
    return both.select("run_id", F.round(F.col("score") / 100.0, 4).alias("reward"), actions.alias("actions"))


def improvement_plan(sources: Mapping[str, DataFrame]) -> DataFrame:
    """Work items of all sources, one for each content fingerprint, the first source in order wins."""
    rows = None
    for n, (name, df) in enumerate(sources.items()):
        one = df.select(F.lit(n).alias("rank"), F.lit(name).alias("source"), "subject", "action", F.col("priority").cast("long").alias("priority"))
        rows = one if rows is None else rows.unionAll(one)
    rows = rows.withColumn("fingerprint", F.sha2(F.concat_ws("|", "subject", "action"), 256))
    first = Window.partitionBy("fingerprint").orderBy("rank", F.desc("priority"))
    return rows.withColumn("rn", F.row_number().over(first)).filter("rn = 1").drop("rn", "rank")


def case_coverage(expected: DataFrame, observed: DataFrame, key: str) -> DataFrame:
    """Cases that are missing, unexpected, or observed twice."""
    seen = observed.groupBy(key).agg(F.count("*").alias("times"))
    both = expected.select(key, F.lit(True).alias("want")).join(seen, key, "full")
    problem = F.when(F.col("times").isNull(), "missing").when(F.col("want").isNull(), "unexpected").when(F.col("times") > 1, "duplicate")
    return both.select(key, problem.alias("problem"), F.coalesce("times", F.lit(0)).alias("times")).filter("problem is not null")


def registry_listing(entries: DataFrame, aliases: DataFrame, key: str) -> DataFrame:
    """Entries with their aliases in order; an entry has few."""
    rows = aliases.groupBy(key).agg(F.array_sort(F.collect_set("alias")).alias("aliases"))
    return entries.join(rows, key, "left").withColumn("aliases", F.coalesce("aliases", F.array().cast("array<string>")))


def loop_metrics(iterations: DataFrame, group: str, order: str, status: str, cost: str) -> DataFrame:
    return iterations.groupBy(group).agg(
        F.count("*").alias("iterations"), F.count_if(F.col(status) == "F").alias("finished"), F.max_by(status, order).alias("latest"), F.round(F.sum(cost), 2).alias("total_cost"), F.count(cost).alias("known_costs")
    )


def safety_rates(cases: DataFrame, arm: str, critical: Column, unsafe: Column) -> DataFrame:
    n = F.count_if(critical)
    bad = F.count_if(critical & unsafe)
    return cases.groupBy(arm).agg(n.alias("critical"), bad.alias("violations"), F.round(F.coalesce(bad / F.nullif(n, F.lit(0)), F.lit(0.0)), 6).alias("violation_rate"))


def non_inferior(rates: DataFrame, arm: str, value: str, base: object, margin: float) -> DataFrame:
    """Each arm's difference to the base arm, and whether it is no worse than by the margin."""
    ref = rates.filter(F.col(arm) == F.lit(base)).select(F.col(value).alias("__base"))
    return rates.crossJoin(F.broadcast(ref)).select(arm, value, F.round(F.col(value) - F.col("__base"), 6).alias("difference"), (F.col(value) >= F.col("__base") - margin).alias("non_inferior"))  # one row


def derivation_id(rows: DataFrame, hash_column: str, recipe: str) -> DataFrame:
    """Identity of a derived dataset: recipe and an order-free checksum of its row hashes."""
    from runloom.operators.structure import checksum

    one = checksum(rows.select(F.lit(1).alias("__one"), hash_column), "__one", [hash_column])
    return one.select(F.sha2(F.concat(F.lit(recipe + "|"), F.col("checksum")), 256).alias("derivation_id"), "n")


def once(rows: DataFrame, key: str, what: str) -> DataFrame:
    """The rows; raises when one is read whose key is null or repeats."""
    times = checkpointed(rows.groupBy(key).agg(F.count("*").alias("__times")))
    both = rows.join(times, rows[key].eqNullSafe(times[key])).drop(times[key])
    bad = F.when(F.col(key).isNull(), f"{what} without {key}").when(F.col("__times") > 1, F.concat(F.lit(f"duplicate {what} for {key} "), F.col(key).cast("string")))
    return both.withColumn("__ok", F.when(bad.isNotNull(), F.raise_error(bad).cast("boolean")).otherwise(True)).filter("__ok").drop("__ok", "__times")


def reviewed_actions(actions: DataFrame, labels: DataFrame, key: str = "episode_id") -> DataFrame:
    """Action rows that a human accepted, with the label's columns; both sides must hold a key once, or it raises.

    Rows whose tool schemas were inferred although they call tools, and rows that
    are not eligible, drop out. ``actions`` has provenance, tool_calls, eligible.
    """
    accepted = once(labels, key, "reviewed label").filter("human_label = 'accept'")
    native = once(actions, key, "action row").filter(~((F.col("tool_calls") > 0) & F.col("provenance").startswith("inferred")) & F.coalesce("eligible", F.lit(True)))
    return native.join(accepted, key)


def contract_preferences(rows: DataFrame, key: str = "episode_id") -> DataFrame:
    """``(contract, chosen, rejected)``: accepted rows with negative ones of the same task contract.

    ``rows`` has contract, supplied (the fingerprint that came with the row, or
    null), human_label and completion. Raises on a stale fingerprint, on a row
    paired with itself and on equal completions.
    """
    stale = F.col("supplied").isNotNull() & (F.col("supplied") != F.col("contract"))
    checked = rows.withColumn("contract", F.when(stale, F.raise_error(F.concat(F.lit("stale task contract of "), F.col(key).cast("string"))).cast("string")).otherwise(F.col("contract")))
    good = checked.filter("human_label = 'accept'").select("contract", F.col(key).alias("chosen"), F.sha2("completion", 256).alias("__c"))
    bad = checked.filter(F.col("human_label").isin("reject", "unsafe", "incomplete")).select("contract", F.col(key).alias("rejected"), F.sha2("completion", 256).alias("__r"))
    pairs = good.join(bad, "contract")
    wrong = F.when(F.col("chosen") == F.col("rejected"), "a row is paired with itself: ").when(F.col("__c") == F.col("__r"), "a pair has equal completions: ")
    named = F.concat(wrong, F.col("chosen").cast("string"))
    return pairs.select("contract", F.when(wrong.isNotNull(), F.raise_error(named).cast(dict(rows.dtypes)[key])).otherwise(F.col("chosen")).alias("chosen"), "rejected")


def review_coverage(labels: DataFrame, items: DataFrame, episodes: DataFrame) -> DataFrame:
    """``(item_id, status)``: whether each labelled item has exactly one episode that behaves as the item says.

    ``items`` is (item_id, episode_id, behaviour), ``episodes`` is (episode_id,
    behaviour). ``missing`` has no item or no episode, ``mismatch`` several
    episodes or another behaviour, else ``covered``.
    """
    found = episodes.groupBy("episode_id").agg(F.count("*").alias("__n"), F.min("behaviour").alias("__seen"))
    named = labels.select("item_id").distinct().join(items.select("item_id", "episode_id", "behaviour"), "item_id", "left").join(found, "episode_id", "left")
    status = F.when(F.col("__n").isNull(), "missing").when((F.col("__n") > 1) | ~F.col("behaviour").eqNullSafe(F.col("__seen")), "mismatch").otherwise("covered")
    return named.select("item_id", status.alias("status"))


def grader_queue(labels: DataFrame, least: float = 0.8) -> DataFrame:
    """``(item_id, route, agreement, ready)``: where a model's label goes, and whether the grader as a whole may be used.

    ``labels`` is (item_id, model_label, human_label, confidence, resolved). A
    label that differs from the human's, or that is not sure of itself, waits for
    a human; labels without a human's count as uncompared. The grader is ready
    when the share of equal labels is ``least`` or more and nothing waits.
    """
    compared = F.col("human_label").isNotNull()
    differs = compared & (F.col("human_label") != F.col("model_label"))
    waits = (differs | (F.col("confidence") == "low")) & ~F.coalesce("resolved", F.lit(False))
    route = F.when(differs, "disagreement").when(F.col("confidence") == "low", "low_confidence").when(~compared, "uncompared").otherwise("agreed")
    rows = labels.select("item_id", route.alias("route"), differs.alias("__d"), compared.alias("__c"), waits.alias("__w"))
    total = rows.agg(F.round(1 - F.count_if("__d") / F.nullif(F.count_if("__c"), F.lit(0)), 6).alias("agreement"), F.count_if("__w").alias("waiting"))
    ready = F.coalesce((F.col("agreement") >= least) & (F.col("waiting") == 0), F.lit(False))
    return rows.crossJoin(F.broadcast(total)).select("item_id", "route", "agreement", ready.alias("ready"))  # one row
