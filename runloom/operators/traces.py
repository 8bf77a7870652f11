"""Operators over normalised trace events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def carry_forward(df: DataFrame, names: list[str], partition: str, *order: str) -> DataFrame:
    """Each column's last value that is not null so far, in the order of each partition."""
    w = Window.partitionBy(partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({n: F.last(n, ignorenulls=True).over(w) for n in names})


def count_of(kind: Column | str) -> Column:
    return F.count(F.when(F.col("event_type") == kind if isinstance(kind, str) else kind, 1))


def trace_signal(events: DataFrame) -> DataFrame:
    """One row a run: how rich its trace is, and its risks in fixed order."""
    final = F.max_by("text", F.when(F.col("event_type") == "tool_result", F.col("event_index")))
    rows = events.groupBy("run_id").agg(
        F.count("*").alias("event_count"),
        F.count_distinct("event_type").alias("event_type_count"),
        F.coalesce(final, F.lit("")).alias("final_answer"),
        count_of("tool_call").alias("tool_call_count"),
        count_of("tool_result").alias("tool_result_count"),
        count_of("api_call").alias("api_call_count"),
        count_of(F.col("event_type").startswith("subagent_")).alias("subagent_event_count"),
        count_of("approval").alias("approval_event_count"),
    )
    tools = F.col("tool_call_count") + F.col("tool_result_count") + F.col("api_call_count")
    risks = F.array_compact(
        F.array(
            F.when(F.col("event_count") == 0, "empty_trace"),
            F.when(F.trim("final_answer") == "", "missing_final_answer"),
            F.when(tools == 0, "no_tool_or_api_events"),
            F.when((F.col("tool_call_count") > 0) & (F.col("tool_call_count") != F.col("tool_result_count")), "tool_call_result_imbalance"),
        )
    )
    return rows.select(
        "run_id", "event_count", "event_type_count", (F.trim("final_answer") != "").alias("has_final_answer"), F.length("final_answer").cast("long").alias("final_answer_chars"),
        "tool_call_count", "tool_result_count", "api_call_count", "subagent_event_count", "approval_event_count", (tools > 0).alias("has_tool_or_api_events"), risks.alias("risks"),
    )


def rate(part: Column, whole: Column, digits: int = 4) -> Column:
    """part / whole rounded, 0 where whole is 0."""
    return F.round(F.coalesce(part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0)), F.lit(0.0)), digits)


def observability_metrics(signal: DataFrame) -> DataFrame:
    """One row over all runs."""
    n = F.count("*")
    return signal.agg(
        n.alias("run_count"),
        F.coalesce(F.sum("event_count"), F.lit(0)).cast("long").alias("total_event_count"),
        rate(F.sum("event_count"), n, 2).alias("average_event_count"),
        F.coalesce(F.min("event_count"), F.lit(0)).alias("min_event_count"),
        F.coalesce(F.max("event_count"), F.lit(0)).alias("max_event_count"),
        F.count_if("has_final_answer").alias("runs_with_final_answer"),
        (n - F.count_if("has_final_answer")).alias("empty_final_answer_count"),
        rate(F.count_if("has_final_answer"), n).alias("final_answer_rate"),
        F.count_if("has_tool_or_api_events").alias("runs_with_tool_or_api_events"),
        rate(F.count_if("has_tool_or_api_events"), n).alias("tool_or_api_run_rate"),
        F.coalesce(F.sum("tool_call_count"), F.lit(0)).cast("long").alias("tool_call_count"),
        F.coalesce(F.sum("tool_result_count"), F.lit(0)).cast("long").alias("tool_result_count"),
    )


def value_counts(df: DataFrame, name: str, as_name: str = "value") -> DataFrame:
    """Counts of values that are not null or empty."""
    return df.filter(F.col(name).isNotNull() & (F.col(name).cast("string") != "")).groupBy(F.col(name).alias(as_name)).agg(F.count("*").alias("n"))


def match_calls(events: DataFrame) -> DataFrame:
    """Tool results joined to calls of the same run and tool, first in first out.

    ``(run_id, tool_name, nth, call_index, result_index)``; the side without a
    partner is null. One shuffle: the n-th call and the n-th result of a tool
    are two rows of one group.
    """
    both = events.filter(F.col("event_type").isin("tool_call", "tool_result"))
    order = Window.partitionBy("run_id", "tool_name", "event_type").orderBy("event_index")
    ranked = both.withColumn("nth", F.row_number().over(order).cast("long"))
    side = lambda kind: F.max(F.when(F.col("event_type") == kind, F.col("event_index")))
    return ranked.groupBy("run_id", "tool_name", "nth").agg(side("tool_call").alias("call_index"), side("tool_result").alias("result_index"))


def pair_by_id_or_queue(calls: list[tuple], results: list[tuple]) -> list[tuple]:
    """Pairs of one session in event order: by id where a result has one that is pending, else the oldest pending call of its tool.

    Items are (index, tool, id). For the fold of sessions that mix both.
    """
    pending: list[tuple] = []
    pairs = []
    for index, kind, tool, key in sorted([(i, 0, t, k) for i, t, k in calls] + [(i, 1, t, k) for i, t, k in results]):
        if kind == 0:
            pending.append((index, tool, key))
            continue
        own = next((c for c in pending if key is not None and c[2] == key), None) or next((c for c in pending if c[1] == tool), None)
        if own:
            pending.remove(own)
        pairs.append((own[0] if own else None, index))
    return pairs + [(c[0], None) for c in pending]


def match_calls_mixed(events: DataFrame) -> DataFrame:
    """As ``match_calls`` for events with tool_call_id, where some results name their call; one fold a run."""
    import pandas as pd

    def fold(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        rows = [(int(i), t, k if isinstance(k, str) else None, e) for i, t, k, e in zip(pdf.event_index, pdf.tool_name, pdf.tool_call_id, pdf.event_type, strict=True)]
        pairs = pair_by_id_or_queue([r[:3] for r in rows if r[3] == "tool_call"], [r[:3] for r in rows if r[3] == "tool_result"])
        out = pd.DataFrame(pairs, columns=["call_index", "result_index"]).astype("Int64")
        return out.assign(run_id=key[0])[["run_id", "call_index", "result_index"]]

    tools = events.filter(F.col("event_type").isin("tool_call", "tool_result")).select("run_id", "event_index", "tool_name", "tool_call_id", "event_type")
    return tools.groupBy("run_id").applyInPandas(fold, "run_id string, call_index long, result_index long")


def tool_signatures(events: DataFrame, args: str = "props") -> DataFrame:
    """Inferred arguments of each tool: name, JSON types seen, and whether every call has it."""
    calls = events.filter(F.col("event_type") == "tool_call").select("tool_name", F.try_parse_json(args).alias("v"))
    whole = calls.groupBy("tool_name").agg(F.count("*").alias("calls"))
    pairs = calls.select("tool_name", F.explode(F.map_entries(F.try_variant_get("v", "$", "map<string,variant>"))).alias("e"))
    kind = F.schema_of_variant(F.col("e.value"))
    name = F.when(kind == "BIGINT", "integer").when(kind.startswith("DECIMAL") | (kind == "DOUBLE"), "number").when(kind == "STRING", "string").when(kind == "BOOLEAN", "boolean").when(kind == "VOID", "null").when(kind.startswith("ARRAY"), "array").otherwise("object")
    seen = pairs.groupBy("tool_name", F.col("e.key").alias("argument")).agg(F.array_join(F.sort_array(F.collect_set(name)), "|").alias("types"), F.count("*").alias("uses"))
    return seen.join(whole, "tool_name").select("tool_name", "argument", "types", "uses", "calls", (F.col("uses") == F.col("calls")).alias("required"))


def evidence_coverage(rules: DataFrame) -> DataFrame:
    """Per rule: runs, passed, failed, and failed with or without an evidence reference."""
    return rules.groupBy("rule_id").agg(
        F.count("*").alias("rule_count"),
        F.count_if("passed").alias("passed"),
        F.count_if(~F.col("passed")).alias("failed"),
        F.count_if(~F.col("passed") & (F.col("evidence_refs") > 0)).alias("failed_with_evidence"),
        F.count_if(~F.col("passed") & (F.col("evidence_refs") == 0)).alias("failed_without_evidence"),
    )
