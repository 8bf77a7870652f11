"""Queries over JSON structure, checksums and evidence links."""

from __future__ import annotations

from pyspark.sql import functions as F

from runloom.functions import text as T
from runloom.operators import structure as S
from runloom.plans.registry import query, with_
from runloom.plans.traces import rules, scored, scores
from runloom.plans.views import SCORES_SQL
from runloom.session import load


def _states(spark, sf_dir):
    k, bal = F.col("c_custkey"), F.floor("c_acctbal").cast("long")
    before = F.to_json(F.struct(F.struct(bal.alias("balance"), F.col("c_mktsegment").alias("segment")).alias("account"), F.array(k % 3, k % 5).alias("tags")))
    after = F.to_json(F.struct(F.struct((bal + F.when(k % 4 == 0, 1).otherwise(0)).alias("balance"), F.when(k % 7 != 0, F.col("c_mktsegment")).alias("segment")).alias("account"), F.when(k % 6 == 0, F.array(k % 3)).otherwise(F.array(k % 3, k % 5)).alias("tags")))
    return load(spark, sf_dir, "customer").select(k.alias("run_id"), before.alias("before"), F.when(k % 50 != 0, after).alias("after"))


@query(
    """with c as (select c_custkey as run_id, c_custkey as k, floor(c_acctbal)::bigint as bal, c_mktsegment as seg from customer where c_custkey % 50 <> 0)
select run_id, '$.account.balance' as path, bal::varchar as before_value, (bal + 1)::varchar as after_value, 'changed' as change from c where k % 4 = 0
union all select run_id, '$.account.segment', '"' || seg || '"', null, 'removed' from c where k % 7 = 0
union all select run_id, '$.tags[1]', (k % 5)::varchar, null, 'removed' from c where k % 6 = 0"""
)
def state_diff_leaves(spark, sf_dir):
    return S.state_diff(_states(spark, sf_dir), "run_id", "before", "after").select("run_id", "path", "before_value", "after_value", "change")


@query(
    """select c_custkey as run_id, case when c_custkey % 50 = 0 then 'unknown' when n > 0 then 'changed' else 'unchanged' end as status, case when c_custkey % 50 = 0 then 0 else n end::bigint as changes, false as truncated
from (select c_custkey, (c_custkey % 4 = 0)::integer + (c_custkey % 7 = 0)::integer + (c_custkey % 6 = 0)::integer as n from customer)"""
)
def state_diff_status(spark, sf_dir):
    return S.diff_status(_states(spark, sf_dir), "run_id", "before", "after")


_SCHEMA = {"type": "object", "required": ["k"], "properties": {"k": {"type": "integer", "minimum": 10, "maximum": 60}}, "additionalProperties": False}


@query("select event_id, case when k < 10 then '$.k: breaks minimum' when k > 60 then '$.k: breaks maximum' end as error from (select event_id, json_extract_string(props, '$.k')::bigint as k from events) where k < 10 or k > 60")
def contract_validation(spark, sf_dir):
    rows = load(spark, sf_dir, "events").select("event_id", F.explode(S.contract_errors(F.col("props"), _SCHEMA)).alias("error"))
    return rows


@query("select event_id, sha256('{\"k\":' || json_extract_string(props, '$.k') || '}') as fingerprint from events")
def canonical_hash(spark, sf_dir):
    return load(spark, sf_dir, "events").select("event_id", F.sha2(T.canonical_json(F.col("props")), 256).alias("fingerprint"))


@query()
def dataset_checksum(spark, sf_dir):
    """Order-free checksums; tested to be the same for any order of rows."""
    return S.checksum(load(spark, sf_dir, "orders").withColumn("day", F.col("o_orderdate").cast("string")), "o_orderstatus", ["o_orderkey", "o_custkey", "day"])


@query("select doc_id, unnest(list_filter(['Licensed', 'token', 'rights'], lambda x: contains(text, x))) as literal from documents")
def forbidden_text_audit(spark, sf_dir):
    return S.forbidden_text(load(spark, sf_dir, "documents"), "doc_id", "text", ["Licensed", "token", "rights"])


@query(with_(SCORES_SQL, "select run_id, 'required_action_sequences' as rule_id, 'look_call_result' as item_id, result_after.at as event_index from result_after union all select h.run_id, 'required_evidence', 'looked', first_look from hits h where first_look is not null"))
def evidence_links(spark, sf_dir):
    rows = S.evidence_links(scored(spark, sf_dir), "run_id").filter("item_id in ('looked', 'look_call_result')")
    return rows.select("run_id", "rule_id", "item_id", "event_index")


@query("select doc_id, n_chars, case when n_chars <= 512 then 'short' when n_chars <= 1024 then 'medium' when n_chars <= 2048 then 'long' else 'extra_long' end as bucket, n_chars > 80 as truncated from documents")
def length_buckets(spark, sf_dir):
    rows = load(spark, sf_dir, "documents").withColumn("p", T.preview(F.col("text")))
    return rows.select("doc_id", "n_chars", T.length_bucket(F.col("n_chars")).alias("bucket"), F.col("p.truncated").alias("truncated"))


_ENDINGS = ("_good", "-bad", "_Pass_fail", "", "_failing-chosen", "_v2", "_passed", "-REJECTED", "_goodness")


@query(
    """select p_partkey, case when p_partkey % 9 in (3, 5, 6, 8) then split_part(p_type, ' ', 1) || ['_good', '-bad', '_Pass_fail', '', '_failing-chosen', '_v2', '_passed', '-REJECTED', '_goodness'][1 + p_partkey % 9]
  else split_part(p_type, ' ', 1) end as family from part"""
)
def scenario_family(spark, sf_dir):
    """Families of scenario ids that end in outcome words, or seem to."""
    ending = F.element_at(F.array(*map(F.lit, _ENDINGS)), (F.col("p_partkey") % 9).cast("int") + 1)
    return load(spark, sf_dir, "part").select("p_partkey", T.family_of(F.concat(F.split("p_type", " ")[0], ending)).alias("family"))


@query("select p_partkey, round(('0x' || substr(sha256(p_name), 1, 16))::ubigint::double / 18446744073709551616.0::double, 9) as u from part")
def hash_to_unit(spark, sf_dir):
    return load(spark, sf_dir, "part").select("p_partkey", F.round(T.unit_interval(F.col("p_name")), 9).alias("u"))


@query(
    """select conv_id, sha256('{"prompt":"' || array_to_string(regexp_extract_all(replace(lower(coalesce(text, '')), 'ß', 'ss'), '[a-z0-9]+'), ' ') || '","system":["be brief"],"tools":["read","tool_' || (conv_id % 3)::varchar || '"]}') as contract
from (select conv_id, arg_min(text, turn) as text from conversations where role = 'user' group by conv_id)"""
)
def task_contracts(spark, sf_dir):
    """Fingerprints of what the first user turn of each conversation asks."""
    first = load(spark, sf_dir, "conversations").filter("role = 'user'").groupBy("conv_id").agg(F.min_by("text", "turn").alias("text"))
    tools = F.array(F.concat(F.lit("tool_"), (F.col("conv_id") % 3).cast("string")), F.lit("read"))
    return first.select("conv_id", S.task_contract(F.col("text"), F.array(F.lit("be brief")), tools).alias("contract"))


@query("select c_custkey, case when c_custkey % 3 = 0 then '-' else length(c_mktsegment)::varchar || ':' || c_mktsegment end || '|' || length(c_nationkey::varchar)::varchar || ':' || c_nationkey::varchar as identity from customer")
def identity_keys(spark, sf_dir):
    return load(spark, sf_dir, "customer").select("c_custkey", S.identity_key(F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")), F.col("c_nationkey")).alias("identity"))


@query("""select event_id, '{"k":' || json_extract_string(props, '$.k') || ',"seen":{"at":' || event_id::varchar || '}}' as props from events""")
def assigned_paths(spark, sf_dir):
    """Events with their number put into their JSON at a path that is not there yet."""
    return load(spark, sf_dir, "events").select("event_id", S.assign_path(F.col("props"), ("seen", "at"), F.col("event_id").cast("string")).alias("props"))


@query(
    with_(
        SCORES_SQL,
        """select s.run_id, case when s.passed then 'PASS: score ' || score::varchar || ', no critical failures.' when n > 0 then 'FAIL: score ' || score::varchar || ', critical failures: ' || names || '.' else 'FAIL: score ' || score::varchar || ' below threshold.' end as summary
from scores s left join (select run_id, count(*) as n, string_agg(rule_id, ', ' order by rule_id) as names from rules where not passed and penalty >= 30 group by run_id) c on s.run_id = c.run_id""",
    )
)
def scorecard_summaries(spark, sf_dir):
    """One sentence a scorecard; rules of 30 points or more are critical here."""
    critical = rules(spark, sf_dir).filter("not passed and penalty >= 30").groupBy("run_id").agg(F.array_sort(F.collect_list("rule_id")).alias("critical"))
    rows = scores(spark, sf_dir).join(critical, "run_id", "left")
    return rows.select("run_id", S.summary(F.col("passed"), F.col("score"), F.coalesce("critical", F.array().cast("array<string>"))).alias("summary"))


@query("select *, (select count(*) from documents where contains(text, 'rights'))::bigint as total, (select count(*) from documents where contains(text, 'rights')) > 20 as truncated from (select doc_id, n_chars from documents where contains(text, 'rights') order by n_chars desc, doc_id limit 20)")
def bounded_findings(spark, sf_dir):
    """The first twenty findings of a report with how many there are; the bound is the report's."""
    return S.bounded(load(spark, sf_dir, "documents").filter(F.contains("text", F.lit("rights"))).select("doc_id", "n_chars"), 20, F.desc("n_chars"), "doc_id")
