"""Queries that build training rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from runloom.operators import datasets as D
from runloom.plans.registry import query, with_
from runloom.plans.traces import rules, scores
from runloom.plans.views import SCORES_SQL, trace_events
from runloom.session import load


@query(with_(SCORES_SQL, "select run_id, score, passed, case when passed then 1.0 else 0.0 end::double as \"binary\", round(score / 100.0::double, 6) as unit, round(score / 100.0::double * 2 - 1, 6) as signed from scores"))
def rewards_three_scales(spark, sf_dir):
    return D.rewards(scores(spark, sf_dir))


@query(with_(SCORES_SQL, "select run_id, task_family, rule_id, penalty::integer as penalty, run_id || ':' || rule_id as failure_id from rules where not passed"))
def failure_modes(spark, sf_dir):
    return D.failure_modes(rules(spark, sf_dir))


CURRICULUM_SQL = (
    SCORES_SQL
    + """,
modes as (
  select task_family, rule_id, count(*)::bigint as n, max(penalty)::bigint as max_penalty, min(run_id) as first_run, count(*)::bigint * 110 + max(penalty)::bigint as priority_score
  from rules where not passed group by task_family, rule_id)"""
)


@query(with_(CURRICULUM_SQL, "select *, case when priority_score >= 150 then 'critical' when priority_score >= 75 then 'high' when priority_score >= 25 then 'medium' else 'low' end as priority_band from modes"))
def curriculum_priority(spark, sf_dir):
    return D.curriculum(D.failure_modes(rules(spark, sf_dir)))


@query(with_(CURRICULUM_SQL, "select task_family, rule_id, priority_score from modes order by priority_score desc, task_family, rule_id limit 5"))
def top_priorities(spark, sf_dir):
    return D.curriculum(D.failure_modes(rules(spark, sf_dir))).orderBy(F.desc("priority_score"), "task_family", "rule_id").limit(5).select("task_family", "rule_id", "priority_score")


@query(
    """with a as (
  select l_orderkey, l_linenumber, l_partkey % 3 as rule_id, -round(o_totalprice / 1000000, 6) as d
  from lineitem join orders on l_orderkey = o_orderkey),
b as (
  select *, count(*) over w as c, row_number() over (partition by l_orderkey, rule_id order by l_linenumber) - 1 as i
  from a window w as (partition by l_orderkey, rule_id)),
e as (select *, first_value(d) over (partition by l_orderkey, rule_id order by l_linenumber) as dd from b)
select l_orderkey as run_id, rule_id, l_linenumber as position, c::bigint as attribution_count, i::bigint as allocation_index,
  case when i = c - 1 then round(d * 1000000)::bigint - round(round(d * 1000000)::bigint / c::double)::bigint * (c - 1)
       else round(round(d * 1000000)::bigint / c::double)::bigint end::bigint as reward_micros
from e"""
)
def step_reward_allocation(spark, sf_dir):
    items, orders = load(spark, sf_dir, "lineitem"), load(spark, sf_dir, "orders")
    # As the SQL rounds: the scaled double itself. F.round with a scale rounds its shortest decimal form, which is half up where the double is just under a half.
    delta = -(F.round(F.col("o_totalprice") / 1000000 * 1000000.0) / 1000000.0)
    rows = items.join(orders, items.l_orderkey == orders.o_orderkey).select(F.col("l_orderkey").alias("run_id"), (F.col("l_partkey") % 3).alias("rule_id"), F.col("l_linenumber").alias("position"), delta.alias("rule_reward_delta"))
    return D.step_rewards(rows).select("run_id", "rule_id", "position", "attribution_count", "allocation_index", "reward_micros")


#: Episodes of one user share a prompt, so pairs stay within a user.
_EPISODES_SQL = SCORES_SQL + ", eps as (select s.run_id, s.task_family, r.user_id::varchar as prompt_hash, s.score, s.passed and r.final_answer is not null as eligible from scores s join runs r on s.run_id = r.run_id)"
_PAIRS_SQL = (
    _EPISODES_SQL
    + """,
pairs as (
  select a.task_family, a.prompt_hash, a.run_id as chosen, b.run_id as rejected, a.score as chosen_score, b.score as rejected_score, a.score - b.score as score_gap
  from eps a join eps b on a.task_family = b.task_family and a.prompt_hash = b.prompt_hash and a.eligible and a.score - b.score >= 20)"""
)


def episodes(spark, sf_dir):
    cards = scores(spark, sf_dir)
    return cards.select("run_id", "task_family", F.col("user_id").cast("string").alias("prompt_hash"), "score", (F.col("passed") & F.col("final_answer").isNotNull()).alias("eligible"))


@query(with_(_PAIRS_SQL, "select * from pairs"))
def preference_pairs(spark, sf_dir):
    return D.preference_pairs(episodes(spark, sf_dir), 20)


@query(with_(_PAIRS_SQL, "select * exclude (nth) from (select *, row_number() over (partition by task_family, prompt_hash order by chosen_score desc, chosen, rejected_score, rejected desc) as nth from pairs) where nth <= 3"))
def preference_pairs_capped(spark, sf_dir):
    return D.preference_pairs(episodes(spark, sf_dir), 20, cap=3)


@query(with_(_PAIRS_SQL, "select p.chosen || '|' || p.rejected as pair_id, c.final_answer as chosen_text, r.final_answer as rejected_text, score_gap from pairs p join runs c on p.chosen = c.run_id join runs r on p.rejected = r.run_id"))
def dpo_view(spark, sf_dir):
    cards = scores(spark, sf_dir)
    pairs = D.preference_pairs(episodes(spark, sf_dir), 20)
    texts = cards.select("run_id", "final_answer")
    c, r = texts.toDF("chosen", "chosen_text"), texts.toDF("rejected", "rejected_text")
    return pairs.join(c, "chosen").join(r, "rejected").select(F.concat_ws("|", "chosen", "rejected").alias("pair_id"), "chosen_text", "rejected_text", "score_gap")


@query(with_(SCORES_SQL, "select s.run_id, s.task_family, r.final_answer as completion from scores s join runs r on s.run_id = r.run_id where s.passed and r.final_answer is not null"))
def sft_view(spark, sf_dir):
    return scores(spark, sf_dir).filter("passed and final_answer is not null").select("run_id", "task_family", F.col("final_answer").alias("completion"))


@query(with_(SCORES_SQL, "select s.run_id, s.score, s.passed as label from scores s join runs r on s.run_id = r.run_id where not s.passed or r.final_answer is not null"))
def reward_model_view(spark, sf_dir):
    """Passing runs that are not eligible as positives are left out."""
    return scores(spark, sf_dir).filter("not passed or final_answer is not null").select("run_id", "score", F.col("passed").alias("label"))


_TURNS_SQL = """
firsts as (select conv_id, min(turn) filter (where role = 'user') as first_turn from conversations group by conv_id),
pre as (
  select c.conv_id, c.turn, c.text as target, f.first_turn,
    (select count(*) from conversations b where b.conv_id = c.conv_id and b.turn < c.turn)::integer as before,
    (select count(*) from conversations b where b.conv_id = c.conv_id and b.turn < c.turn and b.turn >= f.first_turn)::integer as after_first,
    (select string_agg(role, ',' order by turn) from conversations b where b.conv_id = c.conv_id and b.turn < c.turn) as roles,
    (select string_agg(role, ',' order by turn) from conversations b where b.conv_id = c.conv_id and b.turn < c.turn and b.turn >= f.first_turn) as short_roles
  from conversations c join firsts f on c.conv_id = f.conv_id where c.role = 'assistant' and c.turn > f.first_turn)"""


def _turns(spark, sf_dir):
    return load(spark, sf_dir, "conversations")


@query(with_(_TURNS_SQL, "select conv_id, turn, before, roles, target from pre"))
def sft_prefix_explosion(spark, sf_dir):
    return D.prefixes(_turns(spark, sf_dir)).select("conv_id", "turn", "before", F.array_join(F.transform("prefix", lambda m: m["role"]), ",").alias("roles"), "target")


@query(with_(_TURNS_SQL, "select conv_id, turn, after_first, short_roles from pre"))
def compact_prefix(spark, sf_dir):
    rows = D.prefixes(_turns(spark, sf_dir)).withColumn("short", D.compact(F.col("prefix"), F.col("first")))
    return rows.select("conv_id", "turn", F.size("short").alias("after_first"), F.array_join(F.transform("short", lambda m: m["role"]), ",").alias("short_roles"))


@query(
    """with t as (select p_partkey, p_size > 45 as action from part),
c as (select count(*) as n, count(*) filter (where action) as f from t),
x as (select f, greatest(0, ceil((0.2::double * n - f) / (1 - 0.2::double)))::bigint as extra from c),
r as (select p_partkey, row_number() over (order by sha256(p_partkey::varchar), p_partkey) as rn from t where action)
select p_partkey, 0 as copy from t
union all
select p_partkey, unnest(generate_series(1, (floor(extra / f) + case when rn <= extra % f then 1 else 0 end)::bigint))::integer as copy from r, x"""
)
def upweight_actions(spark, sf_dir):
    rows = load(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") > 45).alias("action"))
    return D.upweight(rows, "action", 0.2, "p_partkey").select("p_partkey", "copy")


_SPLIT_SQL = """
fam as (select distinct p_brand as task_family from part),
rk as (select task_family, count(*) over () as n, row_number() over (order by sha256('split-v1:' || task_family), task_family) as rn from fam),
sz as (select *, greatest(1, round_even(n * 0.1, 0))::bigint as v, greatest(1, round_even(n * 0.1, 0))::bigint as t from rk),
sp as (select task_family, case when n < 3 or rn <= n - v - t then 'train' when rn <= n - t then 'validation' else 'test' end as split from sz)"""


@query(with_(_SPLIT_SQL, "select * from sp"))
def family_split(spark, sf_dir):
    return D.family_split(load(spark, sf_dir, "part").withColumnRenamed("p_brand", "task_family"))


@query(with_(_SPLIT_SQL, "select p_type as key, count(distinct split)::bigint as splits, count(*)::bigint as n from part join sp on p_brand = task_family group by p_type having count(distinct split) > 1"))
def split_leakage(spark, sf_dir):
    part = load(spark, sf_dir, "part").withColumnRenamed("p_brand", "task_family")
    rows = part.join(D.family_split(part), "task_family").withColumnRenamed("p_type", "key")
    return D.split_leakage(rows, "key")


_ACTION_SQL = (
    SCORES_SQL
    + """,
fit as (select s.run_id, r.final_answer as response from scores s join runs r on s.run_id = r.run_id where s.passed and r.final_answer is not null),
msg as (
  select ev.run_id, event_index, event_type, case event_type when 'user_message' then 'user:' || text when 'tool_result' then 'tool:' || tool_name || ':' || text when 'assistant_message' then 'assistant:' || text
    else 'call:' || tool_name || ':' || coalesce(props, '{}') end as said
  from ev join fit on ev.run_id = fit.run_id where event_type in ('user_message', 'assistant_message', 'tool_call', 'tool_result'))"""
)


@query(
    with_(
        _ACTION_SQL,
        """select m.run_id, sha256(string_agg(said, chr(10) order by event_index) || chr(10) || 'assistant:' || any_value(response)) as messages_sha256, count(*) filter (where event_type = 'tool_call')::bigint + 1 as action_count,
  count(*) filter (where event_type = 'tool_call')::bigint as tool_call_count, count(*) filter (where event_type = 'tool_result')::bigint as tool_result_count
from msg m join fit on m.run_id = fit.run_id group by m.run_id""",
    )
)
def action_sft_view(spark, sf_dir):
    """Runs that passed, as chat messages with their calls; the digest is of all messages in order."""
    rows = D.action_sft(trace_events(spark, sf_dir).withColumn("args", F.col("props")), scores(spark, sf_dir))
    call = lambda m: m["arguments"].isNotNull()
    line = lambda m: F.when(call(m), F.concat(F.lit("call:"), m["name"], F.lit(":"), m["arguments"])).when(m["role"] == "tool", F.concat(F.lit("tool:"), m["name"], F.lit(":"), m["content"])).otherwise(F.concat(m["role"], F.lit(":"), m["content"]))
    return rows.select("run_id", F.sha2(F.array_join(F.transform("messages", line), "\n"), 256).alias("messages_sha256"), "action_count", "tool_call_count", "tool_result_count")


_ROW_SPLIT_SQL = (
    _SPLIT_SQL.strip()
    + """,
ep as (select p_partkey as episode_id, p_brand as task_family from part),
es as (select episode_id, split from ep join sp on ep.task_family = sp.task_family),
rw as (select l_orderkey * 10 + l_linenumber as row_id, case when l_linenumber % 4 = 0 then (select min(p_brand) from part) when l_linenumber % 4 = 3 then 'no_family' end as task_family, case when l_linenumber % 4 in (1, 3) then l_partkey when l_linenumber = 5 then -1 end as episode_id,
  case when l_linenumber % 4 = 2 then case when l_suppkey % 2 = 0 then -l_partkey else l_partkey end end as chosen, case when l_linenumber % 4 = 2 then l_suppkey end as rejected from lineitem)"""
)


@query(
    with_(
        _ROW_SPLIT_SQL,
        """select row_id, coalesce(s.split, case when rw.episode_id is not null then coalesce(e.split, 'train') end, c.split, r.split, 'train') as split
from rw left join sp s on rw.task_family = s.task_family left join es e on rw.episode_id = e.episode_id left join es c on rw.chosen = c.episode_id left join es r on rw.rejected = r.episode_id""",
    )
)
def row_splits(spark, sf_dir):
    """Rows of several artifacts by family, else episode, else pair, else train."""
    part = load(spark, sf_dir, "part").withColumnRenamed("p_brand", "task_family")
    least = part.agg(F.min("task_family").alias("least"))
    n, p = F.col("l_linenumber"), F.col("l_partkey")
    rows = load(spark, sf_dir, "lineitem").crossJoin(F.broadcast(least)).select(  # one row
        (F.col("l_orderkey") * 10 + n).alias("row_id"), F.when(n % 4 == 0, F.col("least")).when(n % 4 == 3, "no_family").alias("task_family"), F.when((n % 4).isin(1, 3), p).when(n == 5, -1).alias("episode_id"),
        F.when(n % 4 == 2, F.when(F.col("l_suppkey") % 2 == 0, -p).otherwise(p)).alias("chosen_episode_id"), F.when(n % 4 == 2, F.col("l_suppkey")).alias("rejected_episode_id"),
    )
    return D.row_split(rows, D.family_split(part), part.select(F.col("p_partkey").alias("episode_id"), "task_family")).select("row_id", "split")


@query(
    """with f as (select o_orderkey as run_id, o_orderpriority as rule_id, o_custkey % 40 as penalty,
  case o_orderkey % 4 when 0 then ['event #' || (o_custkey % 9)::varchar || ' and event #' || (o_custkey % 7)::varchar || ' differ'] when 1 then ['The Final Answer lacks it', 'nothing'] when 2 then ['no place'] else [] end as ev from orders),
t as (select run_id, rule_id, round(-penalty / 100.0::double, 6) as rule_reward_delta, unnest(case when len(ev) = 0 then ['rule failed'] else ev end) as text from f),
n as (select *, regexp_extract_all(text, 'event #(\\d+)', 1) as named from t)
select run_id, rule_id, case when len(named) > 0 then 'event' when contains(lower(text), 'final answer') then 'final_answer' else 'episode' end as target, unnest(case when len(named) > 0 then named else [null] end)::bigint as event_index, rule_reward_delta from n"""
)
def reward_attribution(spark, sf_dir):
    """What the evidence of failed rules blames: events by number, the final answer, or the episode."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    named = F.concat(F.lit("event #"), (c % 9).cast("string"), F.lit(" and event #"), (c % 7).cast("string"), F.lit(" differ"))
    texts = F.when(k % 4 == 0, F.array(named)).when(k % 4 == 1, F.array(F.lit("The Final Answer lacks it"), F.lit("nothing"))).when(k % 4 == 2, F.array(F.lit("no place"))).otherwise(F.array().cast("array<string>"))
    rows = load(spark, sf_dir, "orders").select(k.alias("run_id"), F.col("o_orderpriority").alias("rule_id"), (c % 40).alias("penalty"), texts.alias("evidence"))
    return D.attributions(rows)
