"""Queries that choose, route and balance rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from runloom.operators import selection as S
from runloom.plans.registry import query, with_
from runloom.session import load

#: Failure modes of the clusters that the suppliers stand for: one of the contract's and two that follow by other strides.
_NAMES = [*sorted(S.ROUTES), "unheard_of"]
_MODES_SQL = f"""names as (select {_NAMES!r} as m),
table_ as (select unnest({list(S.ROUTES)!r}) as mode, unnest({list(S.ROUTES.values())!r}) as route),
ranks as (select unnest({list(S.INTERVENTIONS)!r}) as route, unnest(range({len(S.INTERVENTIONS)})) as cost),
clu as (select s_suppkey as cluster_id, m[1 + s_suppkey % {len(_NAMES)}] as m1, case when s_suppkey % 3 = 0 then m[1 + (s_suppkey * 7) % {len(_NAMES)}] end as m2,
  case when s_suppkey % 17 = 0 then 'CRITICAL' when s_suppkey % 5 > 0 then 'low' end as severity, (s_suppkey % 20) / 20.0::double as confidence, s_acctbal > 2000 as evidence from supplier, names),
mode_rows as (select distinct cluster_id, trim(mode) as mode from (select cluster_id, m1 as mode from clu union all select cluster_id, m2 from clu) where mode is not null),
hits as (select r.cluster_id, r.mode, t.route, k.cost from mode_rows r join table_ t on r.mode = t.mode join ranks k on t.route = k.route),
best as (select cluster_id, arg_min(route, cost) as route, count(distinct route) as n, list('matched:' || mode || '->' || route order by mode) as said from hits group by cluster_id),
forced as (select cluster_id, list_filter([case when lower(severity) = 'critical' then 'high_impact_requires_human_review' end,
  case when m1 = 'grader_disagreement' or m2 = 'grader_disagreement' then 'grader_disagreement_requires_human_review' end, case when confidence < 0.6 then 'low_confidence' end], lambda x: x is not null) as why, evidence from clu)"""


@query(
    with_(
        _MODES_SQL,
        """select f.cluster_id, case when len(why) > 0 or b.route is null or (b.route = 'model_training' and not evidence) then 'human_review' else b.route end as route,
array_to_string(case when len(why) > 0 then why when b.route is null then ['unknown_failure_class'] else list_concat(said, list_filter([case when n > 1 then 'least_cost_adequate_intervention_selected' end,
  case when b.route = 'model_training' and not evidence then 'model_training_requires_capability_evidence' end], lambda x: x is not null)) end, '; ') as reasons
from forced f left join best b on f.cluster_id = b.cluster_id""",
    )
)
def intervention_route(spark, sf_dir):
    """The intervention of each cluster of failures, with its reasons."""
    k, names = F.col("s_suppkey"), F.array(*map(F.lit, _NAMES))
    at = lambda x: F.element_at(names, (x % len(_NAMES)).cast("int") + 1)
    modes = F.array_compact(F.array(at(k), F.when(k % 3 == 0, at(k * 7))))
    severity = F.when(k % 17 == 0, "CRITICAL").when(k % 5 > 0, "low")
    r = load(spark, sf_dir, "supplier").select(k.alias("cluster_id"), S.route(modes, severity, (k % 20) / 20.0, F.col("s_acctbal") > 2000).alias("r"))
    return r.select("cluster_id", "r.route", F.array_join("r.reasons", "; ").alias("reasons"))


@query("select p_partkey, array_to_string(list_sort(list_filter([case when contains(lower(p_type), 'brass') or contains(lower(p_type), 'steel') then 'metal' end, case when contains(lower(p_type), 'small') then 'size' end, case when contains(lower(p_type), 'promo') then 'offer' end], lambda x: x is not null)), ',') as classes from part")
def keyword_routing(spark, sf_dir):
    found = S.keyword_routes(F.col("p_type"), {"metal": ("brass", "steel"), "size": ("small",), "offer": ("promo",)})
    return load(spark, sf_dir, "part").select("p_partkey", F.array_join(found, ",").alias("classes"))


@query(
    """with tasks as (select o_orderkey as task_id, list_filter([case when o_orderkey % 2 = 0 then 'read' end, case when o_orderkey % 3 = 0 then 'write' end, case when o_orderkey % 5 = 0 then 'admin' end], lambda x: x is not null) as needed from orders),
tools as (select * from (values ('reader', ['read'], 1), ('editor', ['read', 'write'], 3), ('root', ['read', 'write', 'admin'], 9), ('writer', ['write'], 2)) t(tool, caps, cost)),
fit as (select task_id, tool, cost from tasks left join tools on list_has_all(caps, needed))
select task_id, arg_min(tool, (cost, tool)) as tool, count(tool)::bigint as eligible from fit group by task_id"""
)
def tool_capability_selection(spark, sf_dir):
    k = F.col("o_orderkey")
    tasks = load(spark, sf_dir, "orders").select(k.alias("task_id"), F.array_compact(F.array(F.when(k % 2 == 0, "read"), F.when(k % 3 == 0, "write"), F.when(k % 5 == 0, "admin"))).alias("needed"))
    tools = spark.createDataFrame([("reader", ["read"], 1), ("editor", ["read", "write"], 3), ("root", ["read", "write", "admin"], 9), ("writer", ["write"], 2)], "tool string, capabilities array<string>, cost int")
    return S.select_tools(tasks, tools)


@query("select c_custkey, case when c_custkey % 4 = 1 then 'specialist' when c_custkey % 3 = 2 then 'composition' else 'generalist' end as adapter from customer")
def adapter_route(spark, sf_dir):
    rows = load(spark, sf_dir, "customer")
    return rows.select("c_custkey", S.adapter_route(F.col("c_custkey") % 4, F.col("c_custkey") % 3).alias("adapter"))


@query(
    """with c as (select n_regionkey as grp, s_suppkey as candidate_id, s_suppkey % 3 as recipe, round(s_acctbal)::bigint as macro, s_acctbal > 1000 as qualified from supplier join nation on s_nationkey = n_nationkey),
e as (select grp from c where qualified group by grp having count(*) >= 2 and count(distinct recipe) >= 2)
select grp, candidate_id, macro from (select c.*, row_number() over (partition by c.grp order by macro desc, candidate_id) as rn from c join e on c.grp = e.grp where qualified) where rn = 1"""
)
def candidate_selection(spark, sf_dir):
    rows = load(spark, sf_dir, "supplier").join(F.broadcast(load(spark, sf_dir, "nation")), F.col("s_nationkey") == F.col("n_nationkey"))
    c = rows.select(F.col("n_regionkey").alias("grp"), F.col("s_suppkey").alias("candidate_id"), (F.col("s_suppkey") % 3).alias("recipe"), F.round("s_acctbal").cast("long").alias("macro"), (F.col("s_acctbal") > 1000).alias("qualified"))
    return S.qualified_winner(c, "grp")


@query("select c_custkey, row_number() over (partition by c_nationkey order by (c_custkey % 2 = 0 and c_acctbal > 0) desc, floor(c_acctbal / 100) desc, c_custkey % 10 desc, c_custkey desc)::bigint as replay_rank from customer")
def replay_ranking(spark, sf_dir):
    k = F.col("c_custkey")
    rows = load(spark, sf_dir, "customer").select(k.alias("row_id"), "c_nationkey", (k % 2 == 0).alias("safe"), (F.col("c_acctbal") > 0).alias("passed"), F.floor(F.col("c_acctbal") / 100).alias("score"), (k % 10).alias("confidence"))
    return S.replay_ranking(rows, "c_nationkey").select(F.col("row_id").alias("c_custkey"), "replay_rank")


@query("select p_partkey, least(100, case when p_size > 10 then 40 else 0 end + case when p_retailprice > 1000 then 35 else 0 end + case when p_type like '%STEEL%' then 30 else 0 end)::integer as quality from part")
def scenario_quality(spark, sf_dir):
    parts = {"long": (F.col("p_size") > 10, 40), "dear": (F.col("p_retailprice") > 1000, 35), "steel": (F.contains("p_type", F.lit("STEEL")), 30)}
    return load(spark, sf_dir, "part").select("p_partkey", S.scenario_quality(parts).cast("int").alias("quality"))


_ROBIN_SQL = """
rob as (select p_partkey, p_brand, row_number() over (partition by p_brand order by sha256('exposure-v1:' || p_partkey::varchar), p_partkey)::bigint as turn from part),
pos as (select *, row_number() over (order by turn, sha256('exposure-v1:' || p_brand), p_brand)::bigint as position from rob)"""


def _robin(spark, sf_dir):
    return S.round_robin(load(spark, sf_dir, "part").select("p_partkey", "p_brand"), "p_brand", "p_partkey")


@query(with_(_ROBIN_SQL, "select p_partkey, p_brand, turn, position from pos"))
def round_robin_strata(spark, sf_dir):
    return _robin(spark, sf_dir)


@query(with_(_ROBIN_SQL, "select p_partkey, position, ((position - 1) // 32)::bigint as batch, ((position - 1) % 32)::bigint as slot from pos"))
def exposure_batches(spark, sf_dir):
    return S.batches(_robin(spark, sf_dir), 32).select("p_partkey", "position", "batch", "slot")


@query(with_(_ROBIN_SQL, "select p_brand, count(*)::bigint as exposures, min((position - 1) // 32)::bigint as first_batch, max((position - 1) // 32)::bigint as last_batch from pos group by p_brand"))
def exposure_coverage(spark, sf_dir):
    return S.batches(_robin(spark, sf_dir), 32).groupBy("p_brand").agg(F.count("*").alias("exposures"), F.min("batch").alias("first_batch"), F.max("batch").alias("last_batch"))


@query("select p_brand, n, w, round(n::double / sum(n) over (), 6) as row_share, round(w::double / sum(w) over (), 6) as weight_share from (select p_brand, count(*)::bigint as n, sum(p_size)::bigint as w from part group by p_brand)")
def share_statistics(spark, sf_dir):
    return S.shares(load(spark, sf_dir, "part"), "p_brand", "p_size")


@query("select * from (select p_brand, round(w::double / sum(w) over (), 6) as weight_share from (select p_brand, sum(p_size)::bigint as w from part group by p_brand)) where weight_share not between 0.038 and 0.042")
def share_band_blockers(spark, sf_dir):
    return S.shares(load(spark, sf_dir, "part"), "p_brand", "p_size").filter("weight_share not between 0.038 and 0.042").select("p_brand", "weight_share")


@query(
    """select o_orderstatus, o_orderpriority, largest, n, total, n * 5 > total as dominant from (
  select *, sum(n) over w::bigint as total, row_number() over (partition by o_orderstatus, o_orderpriority order by n desc, sha256(largest::varchar)) as rn
  from (select o_orderstatus, o_orderpriority, o_custkey % 6 as largest, count(*)::bigint as n from orders group by all) window w as (partition by o_orderstatus, o_orderpriority)) where rn = 1"""
)
def dominance_check(spark, sf_dir):
    rows = load(spark, sf_dir, "orders").withColumn("grp", F.col("o_custkey") % 6)
    return S.dominance(rows, ["o_orderstatus", "o_orderpriority"], "grp")


@query()
def greedy_domain_balance(spark, sf_dir):
    """Rows kept in pools of parts; sequential by nature, tested by its invariants."""
    part = load(spark, sf_dir, "part")
    rows = part.select((F.col("p_partkey") % F.lit(97)).alias("pool"), F.substring("p_brand", 1, 7).alias("domain"), "p_brand", F.col("p_size").cast("long").alias("weight"), "p_partkey")
    return S.balance(rows, "pool", "domain", "p_brand", "weight", "p_partkey")


@query("select p_partkey, sha256(('pick-v1'::blob || '\\x00'::blob || p_brand::blob || '\\x00'::blob || p_partkey::varchar::blob)) as selection_hash from part")
def salted_rank(spark, sf_dir):
    return S.salted_rank(load(spark, sf_dir, "part"), "p_partkey", "pick-v1", "p_brand").select("p_partkey", "selection_hash")


@query(
    """select l_orderkey, l_linenumber from lineitem join part on l_partkey = p_partkey
where l_partkey not in (select s_suppkey * 3 from supplier) and l_suppkey not in (select s_suppkey * 3 from supplier) and p_brand in (select p_brand from part group by p_brand having sum(p_size) % 2 = 0)"""
)
def train_row_filter(spark, sf_dir):
    part = load(spark, sf_dir, "part")
    rows = load(spark, sf_dir, "lineitem").join(part.select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    held = load(spark, sf_dir, "supplier").select((F.col("s_suppkey") * 3).alias("held_out_id"))
    families = part.groupBy("p_brand").agg(F.when(F.sum("p_size") % 2 == 0, "train").otherwise("test").alias("split"))
    return S.train_rows(rows, held, ["l_partkey", "l_suppkey"], families, "p_brand").select("l_orderkey", "l_linenumber")


@query(
    """with a as (select * from orders where o_orderkey % 2 = 0), b as (select * from orders where o_orderkey % 2 = 1)
select 'o_custkey' as key, count(*)::bigint as shared from (select o_custkey from a intersect select o_custkey from b)
union all select 'o_totalprice', count(*)::bigint from (select o_totalprice from a intersect select o_totalprice from b)"""
)
def disjointness(spark, sf_dir):
    rows = load(spark, sf_dir, "orders")
    return S.overlap(rows.filter("o_orderkey % 2 = 0"), rows.filter("o_orderkey % 2 = 1"), ["o_custkey", "o_totalprice"])


@query(
    """with f as (select distinct p_size % 3 as grp, p_brand as family from part), q as (select f.*, sha256('partition-v1:' || grp::varchar || ':' || family) as h, ascii(right(family, 1)) % 2 = 1 as qualified from f),
r as (select *, count(*) over (partition by grp) as n, row_number() over (partition by grp order by qualified desc, h, family) as rn from q),
s as (select *, row_number() over (partition by grp order by rn = 1 desc, h, family) as pos from r)
select grp, family, case when pos <= least(greatest(1, ceil(n * 0.2)), n - 1) then 'validation' else 'fit' end as "partition" from s"""
)
def qualified_partition(spark, sf_dir):
    """Families for fitting and validation, one qualified family first."""
    rows = load(spark, sf_dir, "part").select((F.col("p_size") % 3).alias("grp"), F.col("p_brand").alias("family")).distinct()
    return S.qualified_partition(rows.withColumn("qualified", F.ascii(F.right("family", F.lit(1))) % 2 == 1), "grp", "family", 0.2)
