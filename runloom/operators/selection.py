"""Choosing, routing and balancing rows."""

from __future__ import annotations

from collections.abc import Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

# Fixed values of the contract: interventions from the cheapest to the dearest, and the one that each failure mode asks for.
INTERVENTIONS = ("prompt_policy", "tool_schema", "parser_runtime", "planner_routing", "memory_retrieval", "guardrail_sandbox", "dataset", "evaluation", "model_training", "human_review")
MODES = {
    "prompt_policy": ("ambiguous_instruction", "instruction_conflict", "system_prompt_gap", "low_final_answer_quality"),
    "tool_schema": ("wrong_tool_selection", "invalid_tool_arguments", "missing_tool_description", "tool_schema_drift"),
    "parser_runtime": ("tool_result_parse_error", "serialization_error", "runtime_exception", "adapter_normalization_error"),
    "planner_routing": ("planning_loop", "excessive_retries", "handoff_routing_error", "subagent_coordination_error"),
    "memory_retrieval": ("retrieval_miss", "stale_memory", "context_selection_error"),
    "guardrail_sandbox": ("prompt_injection", "forbidden_action", "unsafe_side_effect", "sandbox_escape"),
    "dataset": ("training_data_contamination", "pii_exposure", "label_error", "duplicate_amplification"),
    "evaluation": ("insufficient_eval_repeats", "eval_identity_mismatch", "benchmark_leakage"),
    "human_review": ("grader_disagreement",),
    "model_training": ("model_capability_shortfall", "capacity_shortfall", "tool_calling_capability_shortfall"),
}
ROUTES = {mode: name for name, modes in MODES.items() for mode in modes}


def route(modes: Column, severity: Column, confidence: Column, evidence: Column) -> Column:
    """``(route, reasons)``: the least-cost intervention that fits a cluster of failures, and why.

    Critical severity, disagreeing graders or a confidence under 0.6 force human
    review, as do modes that no route knows and training without evidence. Modes
    are taken once, in order, without blanks; a null severity is medium, a null
    confidence 0.
    """
    table = F.create_map(*[F.lit(x) for p in ROUTES.items() for x in p])
    rank = F.create_map(*[F.lit(x) for k, name in enumerate(INTERVENTIONS) for x in (name, k)])
    named = F.array_sort(F.array_distinct(F.filter(F.transform(F.coalesce(modes, F.array().cast("array<string>")), F.trim), lambda m: m != "")))
    pairs = F.filter(F.transform(named, lambda m: F.struct(m.alias("mode"), F.try_element_at(table, m).alias("route"))), lambda p: p["route"].isNotNull())
    matched = F.array_distinct(F.transform(pairs, lambda p: F.struct(rank[p["route"]].alias("cost"), p["route"].alias("route"))))
    forced = F.array_compact(
        F.array(
            F.when(F.lower(F.coalesce(severity, F.lit("medium"))) == "critical", "high_impact_requires_human_review"),
            F.when(F.array_contains(named, "grader_disagreement"), "grader_disagreement_requires_human_review"),
            F.when(F.coalesce(confidence, F.lit(0.0)) < 0.6, "low_confidence"),
        )
    )
    unproven = (F.array_min(matched)["route"] == "model_training") & ~F.coalesce(evidence, F.lit(False))
    least = F.concat(
        F.transform(pairs, lambda p: F.concat(F.lit("matched:"), p["mode"], F.lit("->"), p["route"])),
        F.array_compact(F.array(F.when(F.size(matched) > 1, "least_cost_adequate_intervention_selected"), F.when(unproven, "model_training_requires_capability_evidence"))),
    )
    no_match = F.size(matched) == 0
    chosen = F.when((F.size(forced) > 0) | no_match | unproven, "human_review").otherwise(F.array_min(matched)["route"])
    reasons = F.when(F.size(forced) > 0, forced).when(no_match, F.array(F.lit("unknown_failure_class"))).otherwise(least)
    return F.struct(chosen.alias("route"), reasons.alias("reasons"))


def keyword_routes(text: Column, keywords: Mapping[str, tuple[str, ...]]) -> Column:
    """Sorted classes of which a text holds a keyword."""
    low = F.lower(text)
    hits = []
    for name, words in keywords.items():
        found = F.lit(False)
        for w in words:
            found = found | F.contains(low, F.lit(w))
        hits.append(F.when(found, name))
    return F.array_sort(F.array_compact(F.array(*hits)))


def select_tools(tasks: DataFrame, tools: DataFrame) -> DataFrame:
    """The cheapest tool that covers all capabilities of each task; ``tools`` (tool, capabilities, cost) is a catalogue of bounded size."""
    fits = tasks.join(F.broadcast(tools), F.size(F.array_except("needed", "capabilities")) == 0, "left")
    return fits.groupBy("task_id").agg(F.min(F.struct("cost", "tool")).alias("best"), F.count("tool").alias("eligible")).select("task_id", F.col("best.tool").alias("tool"), "eligible")


def adapter_route(specialists: Column, composable: Column) -> Column:
    """A specialist if there is exactly one, a composition if parts cover the task, else the generalist."""
    return F.when(specialists == 1, "specialist").when(composable >= 2, "composition").otherwise("generalist")


def qualified_winner(candidates: DataFrame, group: str, least: int = 2) -> DataFrame:
    """Best qualified candidate of each group by macro score and id, where enough recipes compete."""
    ok = candidates.filter("qualified")
    enough = ok.groupBy(group).agg(F.count("*").alias("n"), F.count_distinct("recipe").alias("recipes")).filter((F.col("n") >= least) & (F.col("recipes") >= 2)).select(group)
    order = Window.partitionBy(group).orderBy(F.desc("macro"), "candidate_id")
    return ok.join(enough, group).withColumn("rn", F.row_number().over(order)).filter("rn = 1").select(group, "candidate_id", "macro")


def replay_ranking(rows: DataFrame, group: str) -> DataFrame:
    """Order for replay: safe and passed first, then score, confidence and id, all descending."""
    order = Window.partitionBy(group).orderBy(F.desc(F.col("safe") & F.col("passed")), F.desc("score"), F.desc("confidence"), F.desc("row_id"))
    return rows.withColumn("replay_rank", F.row_number().over(order).cast("long"))


def scenario_quality(parts: Mapping[str, tuple[Column, int]]) -> Column:
    """Points of the parts that a scenario has, 100 at most."""
    total = F.lit(0)
    for has, points in parts.values():
        total = total + F.when(has, points).otherwise(0)
    return F.least(F.lit(100), total)


def round_robin(rows: DataFrame, stratum: str, key: str, seed: str = "exposure-v1") -> DataFrame:
    """Position of each row when strata in hash order deal their rows in hash order in turn."""
    from runloom.operators.ranking import global_rank

    h = lambda c: F.sha2(F.concat(F.lit(seed + ":"), F.col(c).cast("string")), 256)
    ranked = rows.withColumn("turn", F.row_number().over(Window.partitionBy(stratum).orderBy(h(key), key)).cast("long"))
    return global_rank(ranked, "position", F.col("turn"), h(stratum), F.col(stratum))


def batches(ordered: DataFrame, size: int, position: str = "position") -> DataFrame:
    """Batch of each position and its place in it."""
    return ordered.withColumn("batch", F.floor((F.col(position) - 1) / size).cast("long")).withColumn("slot", ((F.col(position) - 1) % size).cast("long"))


def shares(rows: DataFrame, group: str, weight: str) -> DataFrame:
    """Share of rows and of weight of each group."""
    counts = rows.groupBy(group).agg(F.count("*").alias("n"), F.sum(weight).cast("long").alias("w"))
    total = counts.agg(F.sum("n").alias("tn"), F.sum("w").alias("tw"))
    return counts.crossJoin(F.broadcast(total)).select(group, "n", "w", F.round(F.col("n") / F.col("tn"), 6).alias("row_share"), F.round(F.col("w") / F.col("tw"), 6).alias("weight_share"))  # one row


def dominance(rows: DataFrame, within: list[str], group: str, most: tuple[int, int] = (1, 5)) -> DataFrame:
    """The largest group inside each ``within``, ties by hash, and whether it holds more than the allowed fraction; blanks do not count."""
    kept = rows.filter(F.coalesce(F.trim(F.col(group).cast("string")), F.lit("")) != "")
    counts = kept.groupBy(*within, group).agg(F.count("*").alias("n"))
    w = Window.partitionBy(*within)
    ranked = counts.withColumn("total", F.sum("n").over(w)).withColumn("rn", F.row_number().over(w.orderBy(F.desc("n"), F.sha2(F.col(group).cast("string"), 256))))
    top = ranked.filter("rn = 1")
    return top.select(*within, F.col(group).alias("largest"), "n", F.col("total").cast("long").alias("total"), (F.col("n") * most[1] > F.col("total") * most[0]).alias("dominant"))


def balance(rows: DataFrame, pool: str, domain: str, family: str, weight: str, key: str, share: float = 0.5) -> DataFrame:
    """Rows to keep in each pool after dropping rows of a dominant domain until no domain holds over ``share`` of rows and weight.

    Each step depends on the shares after the step before, so a pool is one
    sequential group; pools are of bounded size. A family never loses its last row.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(key)
        left = {k: (d, f, w) for k, d, f, w in zip(pdf[key], pdf[domain], pdf[family], pdf[weight], strict=True)}
        while left:
            n, total = len(left), sum(x[2] for x in left.values())
            by_n, by_w, fam = {}, {}, {}
            for d, f, w in left.values():
                by_n[d], by_w[d], fam[d, f] = by_n.get(d, 0) + 1, by_w.get(d, 0) + w, fam.get((d, f), 0) + 1
            worst = max(by_n, key=lambda d: (max(by_n[d] / n, by_w[d] / total if total else 0), str(d)))
            if max(by_n[worst] / n, by_w[worst] / total if total else 0) <= share or len(by_n) == 1:
                break
            can = [(w, k) for k, (d, f, w) in left.items() if d == worst and fam[d, f] > 1]
            if not can:
                break
            del left[max(can)[1]]
        return pdf[pdf[key].isin(list(left))][[pool, key]]

    kinds = dict(rows.dtypes)
    return rows.select(pool, domain, family, weight, key).groupBy(pool).applyInPandas(run, f"{pool} {kinds[pool]}, {key} {kinds[key]}")


def salted_rank(rows: DataFrame, key: str, salt: str, stratum: str | None = None) -> DataFrame:
    """Selection order by SHA-256 of salt, stratum and row, with zero bytes between."""
    parts = [F.lit(salt).cast("binary"), *([F.col(stratum).cast("string").cast("binary")] if stratum else []), F.col(key).cast("string").cast("binary")]
    joined = parts[0]
    for p in parts[1:]:
        joined = F.concat(joined, F.unhex(F.lit("00")), p)
    return rows.withColumn("selection_hash", F.sha2(joined, 256))


def train_rows(rows: DataFrame, held_out: DataFrame, id_columns: list[str], families: DataFrame, family: str) -> DataFrame:
    """Rows none of whose ids is held out and whose family trains."""
    out = rows
    for c in id_columns:
        out = out.join(held_out, out[c] == held_out["held_out_id"], "left_anti")
    return out.join(families.filter("split = 'train'").select(family), family, "left_semi")


def overlap(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """How many distinct values of each key both sides hold; all must be zero for disjoint splits."""
    out = None
    for k in keys:
        n = left.select(k).distinct().join(right.select(k).distinct(), k, "left_semi").agg(F.count("*").alias("shared")).select(F.lit(k).alias("key"), "shared")
        out = n if out is None else out.unionAll(n)
    return out


def qualified_partition(families: DataFrame, group: str, family: str, fraction: float, salt: str = "partition-v1") -> DataFrame:
    """``(group, family, partition)``: families of each group for fitting and for validation.

    The first qualified family in hash order validates; then come others, in hash
    order, up to ceil(n * fraction) families, but one at least is left to fit.
    Raises for a group of fewer than two families or two qualified ones.
    ``families`` has (group, family, qualified).
    """
    h = F.sha2(F.concat_ws(":", F.lit(salt), F.col(group).cast("string"), F.col(family).cast("string")), 256)
    w = Window.partitionBy(group)
    rows = families.withColumn("__h", h).withColumn("__n", F.count("*").over(w)).withColumn("__q", F.count_if("qualified").over(w))
    few = (F.col("__n") < 2) | (F.col("__q") < 2)
    rows = rows.withColumn("__n", F.when(few, F.raise_error(F.concat(F.lit("too few families in "), F.col(group).cast("string"))).cast("long")).otherwise(F.col("__n")))
    # The qualified come first, so rank 1 is the first of them; the others follow in hash order whatever they are.
    first = rows.withColumn("__first", F.row_number().over(w.orderBy(F.desc("qualified"), "__h", family)) == 1)
    ranked = first.withColumn("__r", F.row_number().over(w.orderBy(F.desc("__first"), "__h", family)))
    wanted = F.least(F.greatest(F.lit(1), F.ceil(F.col("__n") * fraction)), F.col("__n") - 1)
    return ranked.select(group, family, F.when(F.col("__r") <= wanted, "validation").otherwise("fit").alias("partition"))
