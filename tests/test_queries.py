"""Every registered query against its DuckDB SQL, over the whole small tables."""

import glob
import math
import os
from decimal import Decimal

import duckdb
import pytest

from runloom.plans import registry

DATA = "/root/testdata/sf0.001"
KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.10g}")
    return float(value) if isinstance(value, Decimal) else value


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    df = registry.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    if name not in registry.ORACLES:
        return
    result = duck.execute(registry.ORACLES[name])
    kinds = {d[0]: str(d[1]) for d in result.description}
    rows = result.fetchall()
    assert sorted(kinds) == columns
    assert {c: KINDS[t] for c, t in df.dtypes if t in KINDS} == {c: kinds[c] for c, t in df.dtypes if t in KINDS}
    names = [d[0] for d in result.description]
    assert got == sorted((tuple(plain(dict(zip(names, r, strict=True))[c]) for c in columns) for r in rows), key=repr)


def test_step_reward_allocation_rounds_as_its_sql(spark, tmp_path):
    # Prices that end in .50: a sixth decimal that is half, or just under or over it, as a double.
    con = duckdb.connect()
    con.execute(f"copy (select i as o_orderkey, i + 0.5::double as o_totalprice from range(0, 300000, 7) t(i)) to '{tmp_path}/orders.parquet'")
    con.execute(f"copy (select i as l_orderkey, i % 11 as l_partkey, n::integer as l_linenumber from range(0, 300000, 7) t(i), range(1, 4) u(n)) to '{tmp_path}/lineitem.parquet'")
    for name in ("orders", "lineitem"):
        con.execute(f"create view {name} as select * from '{tmp_path}/{name}.parquet'")
    got = registry.QUERIES["step_reward_allocation"](spark, str(tmp_path)).toArrow()  # noqa: F841
    want = registry.ORACLES["step_reward_allocation"]
    assert con.execute(f"select count(*) from (({want}) except all select run_id, rule_id, position, attribution_count, allocation_index, reward_micros from got)").fetchone() == (0,)
    assert len(got) == con.execute(f"select count(*) from ({want})").fetchone()[0]


def test_entry(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.count() > 0
    assert set(registry.QUERIES) <= set(__spark_entry__.queries())
    assert set(registry.ORACLES) <= set(__spark_entry__.oracle_sql())
