"""Training rows from scored episodes: rewards, attributions, preferences, views, splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from runloom.operators.ranking import global_rank

SPLITS = (("validation", 0.1), ("test", 0.1))


def rewards(cards: DataFrame) -> DataFrame:
    """Rewards of a score on three scales, 6 decimals: binary, 0 to 1, and -1 to 1."""
    unit = F.col("score") / 100.0
    return cards.select("run_id", "score", "passed", F.when(F.col("passed"), 1.0).otherwise(0.0).alias("binary"), F.round(unit, 6).alias("unit"), F.round(unit * 2 - 1, 6).alias("signed"))


def failure_modes(rules: DataFrame) -> DataFrame:
    """One row for each failed rule of a run."""
    return rules.filter(~F.col("passed")).select("run_id", "task_family", "rule_id", "penalty", F.concat_ws(":", "run_id", "rule_id").alias("failure_id"))


def curriculum(modes: DataFrame) -> DataFrame:
    """Failures by family and rule with their priority and its band; every rule is critical."""
    score = F.col("n") * 10 + F.col("n") * 100 + F.col("max_penalty")
    band = F.when(F.col("priority_score") >= 150, "critical").when(F.col("priority_score") >= 75, "high").when(F.col("priority_score") >= 25, "medium").otherwise("low")
    rows = modes.groupBy("task_family", "rule_id").agg(F.count("*").alias("n"), F.max("penalty").cast("long").alias("max_penalty"), F.min("run_id").alias("first_run"))
    return rows.withColumn("priority_score", score).withColumn("priority_band", band)


def step_rewards(attributions: DataFrame, run: str = "run_id", rule: str = "rule_id", order: str = "position", delta: str = "rule_reward_delta") -> DataFrame:
    """Share of a rule's reward for each attribution: an equal part in micro-units, the last takes what is left.

    Micro-units are integers, so the shares of a rule sum to its delta exactly.
    """
    group = Window.partitionBy(run, rule)
    rows = attributions.withColumn("attribution_count", F.count("*").over(group)).withColumn("allocation_index", (F.row_number().over(group.orderBy(order)) - 1).cast("long"))
    whole = F.round(F.col(delta) * 1_000_000).cast("long")
    part = F.round(whole / F.col("attribution_count")).cast("long")
    last = F.col("allocation_index") == F.col("attribution_count") - 1
    return rows.withColumn("reward_micros", F.when(last, whole - part * (F.col("attribution_count") - 1)).otherwise(part))


def preference_pairs(episodes: DataFrame, min_gap: int = 1, cap: int = 0, group: tuple[str, ...] = ("task_family", "prompt_hash")) -> DataFrame:
    """Chosen and rejected episodes of a group whose scores differ by ``min_gap`` at least.

    Chosen must be ``eligible`` and come by score descending and id; its rejected
    partners come in the reverse of that order. ``cap`` bounds the pairs of a
    group in that order (0: all); it is a feature of the sampler, not of the join.
    """
    chosen, rejected = episodes.filter("eligible"), episodes
    if cap:
        # A chosen row's partners are a prefix of the rejected order, so the first cap of either side hold the first cap pairs.
        first = lambda d, *o: d.withColumn("__r", F.row_number().over(Window.partitionBy(*group).orderBy(*o))).filter(F.col("__r") <= cap).drop("__r")
        chosen, rejected = first(chosen, F.desc("score"), "run_id"), first(rejected, "score", F.desc("run_id"))
    a, b = chosen.alias("a"), rejected.alias("b")
    same = F.lit(True)
    for c in group:
        same = same & (F.col(f"a.{c}") == F.col(f"b.{c}"))
    pairs = a.join(b, same & (F.col("a.score") - F.col("b.score") >= min_gap)).select(
        *[F.col(f"a.{c}").alias(c) for c in group], F.col("a.run_id").alias("chosen"), F.col("b.run_id").alias("rejected"), F.col("a.score").alias("chosen_score"), F.col("b.score").alias("rejected_score"), (F.col("a.score") - F.col("b.score")).alias("score_gap")
    )
    if not cap:
        return pairs
    order = Window.partitionBy(*group).orderBy(F.desc("chosen_score"), "chosen", "rejected_score", F.desc("rejected"))
    return pairs.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= cap).drop("nth")


def prefixes(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row for each assistant turn after the first user turn: how many turns come before it and their text.

    Turns are folded into one ordered array a conversation; a prefix is a slice of it.
    """
    whole = turns.groupBy(conv).agg(F.array_sort(F.collect_list(F.struct(turn, role, text))).alias("messages"))
    first = F.array_position(F.transform("messages", lambda m: m[role] == "user"), True)
    rows = whole.withColumn("first", first).filter("first > 0").select(conv, "first", "messages", F.posexplode("messages").alias("pos", "m"))
    kept = rows.filter((F.col("m")[role] == "assistant") & (F.col("pos") >= F.col("first")))
    return kept.select(conv, F.col("m")[turn].alias(turn), F.col("first"), F.col("pos").alias("before"), F.slice("messages", F.lit(1), F.col("pos")).alias("prefix"), F.col("m")[text].alias("target"))


def compact(prefix: Column, first: Column) -> Column:
    """A prefix that starts at the first user turn."""
    return F.slice(prefix, first.cast("int"), F.size(prefix) - first.cast("int") + 1)


def upweight(rows: DataFrame, flag: str, target: float, key: str) -> DataFrame:
    """Rows with ``copy`` 0, and the flagged ones again in order of a hash until they make up ``target`` of all rows."""
    counts = rows.agg(F.count("*").alias("n"), F.count_if(flag).alias("f"))
    extra = F.greatest(F.lit(0), F.ceil((F.lit(target) * F.col("n") - F.col("f")) / F.lit(1 - target)))
    sized = counts.select(F.col("f"), extra.cast("long").alias("extra"))
    ranked = global_rank(rows.filter(flag), "rn", F.sha2(F.col(key).cast("string"), 256), F.col(key)).crossJoin(F.broadcast(sized))  # one row
    times = F.floor(F.col("extra") / F.col("f")) + F.when(F.col("rn") <= F.col("extra") % F.col("f"), 1).otherwise(0)
    copies = ranked.filter("f > 0").withColumn("times", times.cast("int")).filter("times > 0").select(*rows.columns, F.explode(F.sequence(F.lit(1), F.col("times"))).alias("copy"))
    return rows.withColumn("copy", F.lit(0)).unionByName(copies)


def half_even(x: Column) -> Column:
    """Rounding to the even neighbour of a half, as for counts of families."""
    low = F.floor(x)
    return F.when(x - low > 0.5, low + 1).when(x - low < 0.5, low).otherwise(low + low % 2).cast("long")


def family_split(families: DataFrame, seed: str = "split-v1", name: str = "task_family") -> DataFrame:
    """Split of each family by its rank in hash order: train first, then validation and test; under three families all train."""
    rows = families.select(name).distinct().withColumn("h", F.sha2(F.concat(F.lit(seed + ":"), F.col(name)), 256))
    w = Window.partitionBy(F.lit(0))  # one row a family
    ranked = rows.withColumn("n", F.count("*").over(w)).withColumn("rn", F.row_number().over(w.orderBy("h", name)))
    valid = F.greatest(F.lit(1), half_even(F.col("n") * SPLITS[0][1]))
    test = F.greatest(F.lit(1), half_even(F.col("n") * SPLITS[1][1]))
    test = F.when(valid + test >= F.col("n"), F.greatest(F.lit(0), test - (valid + test - F.col("n") + 1))).otherwise(test)
    train = F.col("n") - valid - test
    split = F.when((F.col("n") < 3) | (F.col("rn") <= train), "train").when(F.col("rn") <= train + valid, "validation").otherwise("test")
    return ranked.select(name, split.alias("split"))


def split_leakage(rows: DataFrame, key: str, split: str = "split") -> DataFrame:
    """Keys that occur in more than one split."""
    return rows.groupBy(key).agg(F.count_distinct(split).alias("splits"), F.count("*").alias("n")).filter("splits > 1")


def action_sft(events: DataFrame, cards: DataFrame) -> DataFrame:
    """``(run_id, prompt, response, messages, action_count, tool_call_count, tool_result_count)`` of runs that may be learnt from.

    A run counts if it passed, has an answer and every call of it names its tool.
    Its events become chat messages in order: user and assistant texts, calls as
    assistant messages with their arguments, results as tool messages; the answer
    comes last unless it is there already. One ordered fold a run.
    """
    fit = cards.filter("passed and final_answer is not null").select("run_id", F.col("final_answer").alias("response"))
    kept = events.filter(F.col("event_type").isin("user_message", "assistant_message", "tool_call", "tool_result")).join(fit, "run_id", "left_semi")
    role = F.when(F.col("event_type") == "user_message", "user").when(F.col("event_type") == "tool_result", "tool").otherwise("assistant")
    call = F.col("event_type") == "tool_call"
    message = F.struct("event_index", role.alias("role"), F.when(call, "").otherwise(F.coalesce("text", F.lit(""))).alias("content"), F.when(call | (role == "tool"), F.col("tool_name")).alias("name"), F.when(call, F.coalesce("args", F.lit("{}"))).alias("arguments"))
    whole = kept.groupBy("run_id").agg(
        F.array_sort(F.collect_list(message)).alias("said"), F.count_if(call).alias("tool_call_count"), F.count_if(role == "tool").alias("tool_result_count"),
        F.count_if(call & (F.coalesce("tool_name", F.lit("")) == "")).alias("nameless"), F.min_by("text", F.when(role == "user", F.col("event_index"))).alias("prompt"),
    )
    rows = whole.filter("nameless = 0").join(fit, "run_id")
    last = F.try_element_at("said", F.lit(-1))
    closing = F.array(F.struct(F.lit(2**62).cast("long").alias("event_index"), F.lit("assistant").alias("role"), F.col("response").alias("content"), F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("arguments")))
    there = F.coalesce((last["role"] == "assistant") & (last["content"] == F.col("response")), F.lit(False))
    said = F.when(there, F.col("said")).otherwise(F.concat("said", closing))
    rows = rows.withColumn("messages", F.transform(said, lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"), m["name"].alias("name"), m["arguments"].alias("arguments"))))
    actions = F.size(F.filter("messages", lambda m: m["role"] == "assistant")).cast("long")
    return rows.select("run_id", "prompt", "response", "messages", actions.alias("action_count"), "tool_call_count", "tool_result_count")


def row_split(rows: DataFrame, families: DataFrame, episodes: DataFrame) -> DataFrame:
    """``rows`` with their split: by their own family, else their episode's, else that of the chosen or rejected episode, else train.

    ``rows`` may have task_family, episode_id, chosen_episode_id and
    rejected_episode_id; ``families`` is (task_family, split), ``episodes`` is
    (episode_id, task_family).
    """
    known = episodes.join(families, "task_family").select("episode_id", "split")
    null = F.lit(None).cast("string")
    out = rows
    for c in ("task_family", "episode_id", "chosen_episode_id", "rejected_episode_id"):
        if c not in rows.columns:
            out = out.withColumn(c, null)
    out = out.join(families.toDF("task_family", "__own"), "task_family", "left")
    for c, name in (("episode_id", "__episode"), ("chosen_episode_id", "__chosen"), ("rejected_episode_id", "__rejected")):
        out = out.join(known.toDF(c, name), c, "left")
    # A row that names an episode is decided by it, even where that episode has no family.
    own = F.coalesce("__own", F.when(F.col("episode_id").isNotNull(), F.coalesce("__episode", F.lit("train"))), "__chosen", "__rejected", F.lit("train"))
    return out.select(*rows.columns, own.alias("split"))


def attributions(failures: DataFrame, evidence: str = "evidence") -> DataFrame:
    """``(run_id, rule_id, target, event_index, rule_reward_delta)``: what each evidence text of a failed rule blames.

    A text names events as ``event #n``, each of which is blamed; else the final
    answer if it speaks of it; else the episode. ``failures`` is (run_id, rule_id,
    penalty, evidence array<string>); no evidence counts as one that names nothing.
    """
    texts = F.when(F.size(F.coalesce(F.col(evidence), F.array().cast("array<string>"))) > 0, F.col(evidence)).otherwise(F.array(F.lit("rule failed")))
    rows = failures.select("run_id", "rule_id", F.round(-F.col("penalty") / 100.0, 6).alias("rule_reward_delta"), F.explode(texts).alias("text"))
    named = F.regexp_extract_all("text", F.lit(r"event #(\d+)"), F.lit(1)).cast("array<bigint>")
    target = F.when(F.size(named) > 0, "event").when(F.contains(F.lower("text"), F.lit("final answer")), "final_answer").otherwise("episode")
    return rows.select("run_id", "rule_id", target.alias("target"), F.explode_outer(named).alias("event_index"), "rule_reward_delta")
