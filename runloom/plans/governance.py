"""Queries over data quality and governance."""

from __future__ import annotations

from pyspark.sql import functions as F

from runloom.functions import text as T
from runloom.operators import governance as G
from runloom.plans.registry import query, with_
from runloom.session import load

NORM_SQL = "norm as (select conv_id, turn, conv_id * 1000 + turn as id, text, list_distinct(regexp_extract_all(replace(lower(coalesce(text, '')), 'ß', 'ss'), '[a-z0-9]+')) as toks, array_to_string(regexp_extract_all(replace(lower(coalesce(text, '')), 'ß', 'ss'), '[a-z0-9]+'), ' ') as n from conversations)"


def turns(spark, sf_dir):
    return load(spark, sf_dir, "conversations").withColumn("id", F.col("conv_id") * 1000 + F.col("turn"))


@query(with_(NORM_SQL, "select id, min(id) over (partition by sha256(n)) as representative, count(*) over (partition by sha256(n))::bigint as copies from norm"))
def exact_duplicates(spark, sf_dir):
    return G.exact_duplicates(turns(spark, sf_dir), "id", "text")


DOCS_SQL = NORM_SQL.replace("select conv_id, turn, conv_id * 1000 + turn as id, text", "select doc_id as id, text").replace("from conversations", "from documents")
#: The contract's similarity of near duplicates.
NEAR = 0.9
_JACCARD_SQL = (
    DOCS_SQL
    + """,
reps as (select min(id) as id, any_value(toks) as toks from norm group by n),
prs as (
  select a.id as a, b.id as b, len(list_intersect(a.toks, b.toks))::double / len(list_distinct(list_concat(a.toks, b.toks))) as s
  from reps a join reps b on a.id < b.id and len(a.toks) > 0 and len(b.toks) > 0 and len(b.toks) >= 0.9 * len(a.toks) - 1e-9 and len(a.toks) >= 0.9 * len(b.toks) - 1e-9)"""
)


def docs(spark, sf_dir):
    return load(spark, sf_dir, "documents").withColumnRenamed("doc_id", "id")


def _reps(spark, sf_dir):
    rows = docs(spark, sf_dir)
    same = G.exact_duplicates(rows, "id", "text").filter("id = representative")
    return rows.join(same, "id", "left_semi")


@query(with_(_JACCARD_SQL, "select a, b, round(s, 6) as similarity from prs where s >= 0.9 - 1e-12"))
def token_jaccard_pairs(spark, sf_dir):
    return G.jaccard_pairs(G.token_rows(_reps(spark, sf_dir), "id", "text"), None, "id", NEAR)


_CLUSTER_SQL = (
    "recursive "
    + _JACCARD_SQL
    + """,
lnk as (select a, b from prs where s >= 0.9 - 1e-12 union all select b, a from prs where s >= 0.9 - 1e-12),
walk as (select id as node, id as here from reps union select w.node, l.b from walk w join lnk l on w.here = l.a),
comp as (select node, min(here) as cluster from walk group by node),
clu as (select norm.id, c.cluster from norm join (select n, min(id) as rep from norm group by n) r on norm.n = r.n join comp c on c.node = r.rep)"""
)


@query(with_(_CLUSTER_SQL, "select id, cluster from clu"))
def near_dup_clusters(spark, sf_dir):
    """Clusters of documents by token Jaccard alone, as its SQL has it; ``contamination_clusters`` has the ratio too."""
    return G.near_duplicate_clusters(docs(spark, sf_dir), "id", "text", NEAR, ratio=False)


@query(
    with_(
        _CLUSTER_SQL,
        """select id, cluster, case when u < 0.1 then 'test' when u < 0.2 then 'validation' else 'train' end as split
from (select *, ('0x' || substr(sha256('cluster-v1:' || cluster::varchar), 1, 16))::ubigint::double / 18446744073709551616.0::double as u from clu)""",
    )
)
def clustered_split(spark, sf_dir):
    """Splits of the clusters of ``near_dup_clusters``: token Jaccard alone."""
    return G.clustered_split(near_dup_clusters(spark, sf_dir), "id")


_SHINGLE_SQL = """
dt as (select doc_id, regexp_extract_all(lower(replace(text, 'ß', 'ss')), '[a-z0-9]+') as w from documents),
bt as (select item_id, regexp_extract_all(lower(replace(text, 'ß', 'ss')), '[a-z0-9]+') as w from benchmark),
ds as (select distinct doc_id, array_to_string(w[i:i + 4], ' ') as s from (select doc_id, w, unnest(generate_series(1, len(w) - 4)) as i from dt where len(w) >= 5)),
bs as (select distinct item_id, array_to_string(w[i:i + 4], ' ') as s from (select item_id, w, unnest(generate_series(1, len(w) - 4)) as i from bt where len(w) >= 5)),
dn as (select doc_id, count(*) as n from ds group by doc_id), bn as (select item_id, count(*) as n from bs group by item_id),
ov as (select doc_id, item_id, count(*) as c from ds join bs on ds.s = bs.s group by doc_id, item_id),
sim as (select ov.doc_id, ov.item_id, round(c::double / (dn.n + bn.n - c), 6) as similarity from ov join dn on ov.doc_id = dn.doc_id join bn on ov.item_id = bn.item_id)"""


@query(with_(_SHINGLE_SQL, "select doc_id, similarity, item_id as matched from (select *, row_number() over (partition by doc_id order by similarity desc, item_id) as rn from sim) where rn = 1"))
def contamination_protected(spark, sf_dir):
    """The protected passage that each document overlaps most, by 5-token shingles."""
    return G.max_shingle_overlap(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"), "doc_id", "item_id", "text")


@query()
def pii_scan(spark, sf_dir):
    """Kinds of personal data in every document. The detectors look around matches, which DuckDB's patterns cannot; tested against Python's."""
    rows = load(spark, sf_dir, "documents").select("doc_id", T.personal_data(F.col("text")).alias("kinds"))
    return rows.filter(F.size("kinds") > 0).select("doc_id", F.array_join("kinds", ",").alias("kinds"))


@query()
def secret_scan(spark, sf_dir):
    return load(spark, sf_dir, "documents").select("doc_id", T.has_secret(F.col("text")).alias("has_secret")).filter("has_secret")


@query()
def redact_text(spark, sf_dir):
    """Every document with its secret values masked."""
    return load(spark, sf_dir, "documents").select("doc_id", T.redacted(F.col("text")).alias("text"))


@query("select doc_id, sha256(array_to_string(regexp_extract_all(lower(replace(replace(text, 'ß', 'ss'), 'ẞ', 'ss')), '[a-z0-9]+'), ' ')) as content from documents")
def normalised_content(spark, sf_dir):
    return load(spark, sf_dir, "documents").select("doc_id", F.sha2(T.normalise(F.col("text")), 256).alias("content"))


_GOV_SQL = """
gov as (
  select c_custkey as row_id, case when c_custkey % 11 = 0 then '' else c_name end as owner, case when c_custkey % 4 = 0 then 'Consent' else 'contract' end as legal_basis,
    case when c_custkey % 8 = 0 then null else 'c' || c_custkey::varchar end as consent_id, case c_mktsegment when 'BUILDING' then 'unknown' when 'MACHINERY' then 'none' else 'cc-by' end as license,
    case when c_custkey % 3 = 0 then ['training', 'evaluation'] else ['evaluation'] end as allowed_purposes,
    case when c_custkey % 13 = 0 then null else timestamp '2024-01-01 00:00:00' + to_days((c_custkey % 900)::integer) end as retention_expires_at from customer)"""


@query(
    with_(
        _GOV_SQL,
        """select row_id, array_to_string(reasons, ',') as reasons, len(reasons) = 0 as authorized from (select row_id, list_sort(list_filter([
  case when trim(owner) = '' or retention_expires_at is null then 'missing_governance_metadata' end,
  case when not list_contains(allowed_purposes, 'training') then 'purpose_not_authorized' end,
  case when lower(legal_basis) = 'consent' and consent_id is null then 'consent_identifier_missing' end,
  case when license in ('unknown', 'none') then 'license_not_approved' end,
  case when retention_expires_at is null then 'retention_invalid' when retention_expires_at <= timestamp '2025-01-01 00:00:00' then 'retention_expired' end], lambda x: x is not null)) as reasons from gov)""",
    )
)
def governance_reasons(spark, sf_dir):
    k = F.col("c_custkey")
    rows = load(spark, sf_dir, "customer").select(
        k.alias("row_id"), F.when(k % 11 == 0, "").otherwise(F.col("c_name")).alias("owner"), F.when(k % 4 == 0, "Consent").otherwise("contract").alias("legal_basis"),
        F.when(k % 8 != 0, F.concat(F.lit("c"), k.cast("string"))).alias("consent_id"), F.when(F.col("c_mktsegment") == "BUILDING", "unknown").when(F.col("c_mktsegment") == "MACHINERY", "none").otherwise("cc-by").alias("license"),
        F.when(k % 3 == 0, F.array(F.lit("training"), F.lit("evaluation"))).otherwise(F.array(F.lit("evaluation"))).alias("allowed_purposes"),
        F.when(k % 13 != 0, F.expr("timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(cast(c_custkey % 900 as int))")).alias("retention_expires_at"), F.lit("").alias("text"),
    )
    out = G.governance_reasons(rows, "training", F.expr("timestamp_ntz '2025-01-01 00:00:00'"), "text")
    return out.select("row_id", F.array_join("reasons", ",").alias("reasons"), "authorized")


@query(
    """with r as (select p_partkey as row_id, p_size::double as quality_score, p_brand as source_id, split_part(p_type, ' ', 1) as training_role from part),
m as (select *, case when quality_score < 10 then 'minimum_quality' when training_role not in ('STANDARD', 'SMALL', 'ECONOMY') then 'role_not_allowed' end as base, sha256('curation-v1:' || row_id::varchar) as h from r),
n as (select *, row_number() over (partition by source_id order by quality_score desc, h, row_id) as nth from m where base is null),
p as (select *, row_number() over (order by quality_score desc, h, row_id) as place from n where nth <= 12),
t as (select source_id, count(*) filter (where place <= 150) as taken from p group by source_id)
select row_id, base as reason from m where base is not null
union all select row_id, case when place <= 150 then 'selected' else 'row_cap' end from p
union all select row_id, case when coalesce(taken, 0) >= 12 then 'source_cap' else 'row_cap' end from n left join t on n.source_id = t.source_id where nth > 12"""
)
def curation_caps(spark, sf_dir):
    part = load(spark, sf_dir, "part").select(F.col("p_partkey").alias("row_id"), F.col("p_size").cast("double").alias("quality_score"), F.col("p_brand").alias("source_id"), F.split("p_type", " ")[0].alias("training_role"))
    return G.curate(part, 10, ["STANDARD", "SMALL", "ECONOMY"], 12, 150).select("row_id", "reason")


_LINEAGE_SQL = "edg as (select s_suppkey // 2 as parent, s_suppkey as child from supplier where s_suppkey % 5 <> 0), vers as (select s_suppkey as version, s_suppkey in (3, 7, 20) as direct from supplier), clo as (select version, 0 as distance from vers where direct union select e.child, c.distance + 1 from clo c join edg e on c.version = e.parent where c.distance < 60), cls as (select version, min(distance)::integer as distance from clo group by version)"


def _lineage(spark, sf_dir):
    s = load(spark, sf_dir, "supplier")
    edges = s.filter("s_suppkey % 5 <> 0").select(F.floor(F.col("s_suppkey") / 2).cast("long").alias("parent"), F.col("s_suppkey").alias("child"))
    return G.deletion_closure(s.select(F.col("s_suppkey").alias("version"), F.col("s_suppkey").isin(3, 7, 20).alias("direct")), edges)


@query(with_("recursive " + _LINEAGE_SQL, "select version, distance from cls"))
def deletion_closure(spark, sf_dir):
    return _lineage(spark, sf_dir)


@query(
    with_(
        "recursive " + _LINEAGE_SQL + ", rw as (select l_orderkey * 10 + l_linenumber as row_id, l_suppkey as version, 'subject_' || (l_orderkey % 50)::varchar as subject from lineitem)",
        "select row_id, rw.version, coalesce(distance, -1)::integer as distance, case when subject in ('subject_7', 'subject_21') then 'subject' else 'derived' end as deletion_reason from rw left join cls on rw.version = cls.version where subject in ('subject_7', 'subject_21') or distance > 0",
    )
)
def deletion_plan(spark, sf_dir):
    rows = load(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row_id"), F.col("l_suppkey").alias("version"), F.array(F.concat(F.lit("subject_"), (F.col("l_orderkey") % 50).cast("string"))).alias("deletion_subject_ids")
    )
    return G.deletion_plan(rows, _lineage(spark, sf_dir), ["subject_7", "subject_21"]).select("row_id", "version", "distance", "deletion_reason")


@query(
    """select grp, p_brand, size, case when running - size < 3000 and rn < n then 'dev' else 'train' end as "partition" from (
  select *, sum(size) over w as running, row_number() over w as rn, count(*) over (partition by grp) as n from (select p_size % 4 as grp, p_brand, sum(p_size)::bigint as size from part group by all)
  window w as (partition by grp order by sha256('partition-v1:' || p_brand), p_brand))"""
)
def source_partition(spark, sf_dir):
    fam = load(spark, sf_dir, "part").groupBy((F.col("p_size") % 4).alias("grp"), "p_brand").agg(F.sum("p_size").alias("size"))
    return G.source_partition(fam, "grp", "p_brand", "size", 3000)


@query()
def sequence_matcher_similarity(spark, sf_dir):
    """Similarity of neighbouring turns: the larger of token Jaccard and matching-blocks ratio."""
    from pyspark.sql import Window

    rows = turns(spark, sf_dir).withColumn("before", F.lag("text").over(Window.partitionBy("conv_id").orderBy("turn"))).filter("before is not null")
    a, b = F.array_distinct(T.tokens(F.col("before"))), F.array_distinct(T.tokens(F.col("text")))
    jaccard = F.coalesce(F.size(F.array_intersect(a, b)) / F.nullif(F.size(F.array_union(a, b)), F.lit(0)), F.lit(1.0))
    return rows.select("id", F.round(jaccard, 6).alias("jaccard"), F.round(F.greatest(jaccard, T.sequence_ratio(T.normalise(F.col("before")), T.normalise(F.col("text")))), 6).alias("similarity"))


@query()
def contamination_report(spark, sf_dir):
    """Clusters of first turns by tokens or matching blocks, and those that straddle splits; beyond SQL, tested against all pairs."""
    first = load(spark, sf_dir, "conversations").filter("role = 'user'").groupBy("conv_id").agg(F.min_by("text", "turn").alias("text"))
    split = F.when(F.col("conv_id") % 5 == 0, "test").when(F.col("conv_id") % 7 != 0, "train")
    return G.contamination_report(first.withColumn("split", split), "conv_id", "text", "split")


@query(
    with_(
        "recursive " + _LINEAGE_SQL + ", mdl as (select distinct l_orderkey % 100 as model, l_suppkey as version from lineitem)",
        "select model, count(*)::bigint as versions from mdl join cls on mdl.version = cls.version group by model",
    )
)
def model_quarantine(spark, sf_dir):
    """Models that learnt from a version that a deletion affects."""
    models = load(spark, sf_dir, "lineitem").select((F.col("l_orderkey") % 100).alias("model"), F.col("l_suppkey").alias("version"))
    return G.quarantine(models, _lineage(spark, sf_dir))


@query(
    """with recursive edg as (select s_suppkey // 2 as parent, s_suppkey as child from supplier where s_suppkey % 5 <> 0 and s_suppkey > 0 and s_suppkey // 2 in (select s_suppkey from supplier)
  union select s_suppkey // 3, s_suppkey from supplier where s_suppkey % 4 = 0 and s_suppkey > 0 and s_suppkey // 3 in (select s_suppkey from supplier)),
walk as (select s_suppkey as version, 0 as level from supplier union select e.child, w.level + 1 from walk w join edg e on w.version = e.parent)
select version, max(level)::integer as level from walk group by version"""
)
def lineage_order(spark, sf_dir):
    """Versions with the longest way from a root: a topological order; cycles raise. Number 0 would be its own parent and is a root."""
    s = load(spark, sf_dir, "supplier")
    half = s.filter("s_suppkey % 5 <> 0 and s_suppkey > 0").select(F.floor(F.col("s_suppkey") / 2).cast("long").alias("parent"), F.col("s_suppkey").alias("child"))
    third = s.filter("s_suppkey % 4 = 0 and s_suppkey > 0").select(F.floor(F.col("s_suppkey") / 3).cast("long").alias("parent"), F.col("s_suppkey").alias("child"))
    return G.lineage_levels(s.select(F.col("s_suppkey").alias("version")), half.unionAll(third))
