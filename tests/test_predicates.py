"""The compiled predicate language against a plain evaluator."""

import json
import re

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from runloom.functions import predicates as P

MISSING = object()
DOCS = [
    {"a": {"b": [1, 2.0, "x"], "c": None}, "s": "line one\nline two", "n": 1, "t": True},
    {"a": {"b": [{"k": "v", "ok": True}, {"k": "w", "ok": False}]}, "s": "", "n": 1.0},
    {"a": {"b": {"x": {"k": "v"}, "y": {"k": "z"}}}, "n": 0, "t": False},
    {"a": [], "s": None, "items": [{"p": 1}, {"q": 2}]},
    {},
]


def model_path(v, parts):
    if "*" in parts:
        def spread(x, rest):
            if not rest:
                return [x]
            if rest[0] == "*":
                inner = x.values() if isinstance(x, dict) else x if isinstance(x, list) else []
                return [z for y in inner for z in spread(y, rest[1:])]
            y = step(x, rest[0])
            return [] if y is MISSING else spread(y, rest[1:])
        return spread(v, parts), True
    for p in parts:
        v = step(v, p)
        if v is MISSING:
            break
    return v, False


def step(v, p):
    if isinstance(v, dict) and p in v:
        return v[p]
    if isinstance(v, list) and p.isdigit() and int(p) < len(v):
        return v[int(p)]
    return MISSING


def model_text(v):
    return "" if v is None or v is MISSING else v if isinstance(v, str) else json.dumps(v, sort_keys=True, ensure_ascii=False)


def model_holds(v, c):
    if not (isinstance(c, dict) and any(o in c for o in P.OPERATORS)):
        return v is not MISSING and v == c
    if "present" in c and bool(c["present"]) != (v is not MISSING):
        return False
    if "equals" in c and (v is MISSING or v != c["equals"]):
        return False
    if "contains" in c and (v is MISSING or str(c["contains"]) not in model_text(v)):
        return False
    return not ("matches" in c and (v is MISSING or not re.search(c["matches"], model_text(v), re.DOTALL)))


def model(doc, field, c):
    v, wild = model_path(doc, field.split("."))
    if not wild:
        return model_holds(v, c)
    if isinstance(c, dict) and "present" in c:
        rest = {k: x for k, x in c.items() if k != "present"}
        return bool(v) == bool(c["present"]) and (not rest or any(model_holds(x, rest) for x in v))
    return any(model_holds(x, c) for x in v)


FIELDS = ["a", "a.b", "a.b.0", "a.b.*", "a.b.*.k", "a.*", "s", "n", "t", "items.*.p", "zz"]
CONSTRAINTS = st.one_of(
    st.sampled_from([1, 1.0, "x", "v", None, True, {"equals": "v"}, {"equals": 1}, {"present": True}, {"present": False}, {"contains": "ine"}, {"matches": "one.line"}, {"matches": "^$"}, {"present": True, "equals": "w"}, {"contains": '"k": "v"'}])
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(FIELDS), CONSTRAINTS), min_size=4, max_size=10))
def test_constraints(spark, checks):
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(DOCS)], "i int, j string").withColumn("v", F.parse_json("j"))
    columns = [P.holds(f, c, {}, F.col("v")).alias(f"c{k}") for k, (f, c) in enumerate(checks)]
    for row in df.select("i", *columns).collect():
        for k, (f, c) in enumerate(checks):
            assert row[f"c{k}"] == model(DOCS[row["i"]], f, c), (DOCS[row["i"]], f, c)


def test_where_any_needs_one_object(spark):
    df = spark.createDataFrame([(json.dumps(d),) for d in DOCS], "j string").withColumn("v", F.parse_json("j"))
    same = {"where_any": {"path": "a.b", "where": {"k": "v", "ok": True}}}
    across = {"where_any": {"path": "a.b", "where": {"k": "v", "ok": False}}}
    rows = df.select(P.state_predicate(same, F.col("v")).alias("s"), P.state_predicate(across, F.col("v")).alias("x")).collect()
    assert [r["s"] for r in rows] == [False, True, False, False, False]
    assert not any(r["x"] for r in rows)


def test_precedence_and_merge():
    assert P.text_constraint({"pattern": "p", "contains": "c", "equals": "e"}) == {"equals": "e"}
    assert P.constraints({"where": {"a": 1}, "field_equals": {"a": 2}, "field": "text", "matches": "m"}) == {"a": {"equals": 2}, "text": {"matches": "m"}}
    assert P.constraints({"contains": "x"}) == {"all": {"contains": "x"}}


def test_missing_state_fails(spark):
    df = spark.createDataFrame([(None,)], "j string").select(P.state_predicate({"where": {"a": {"present": False}}}, F.try_parse_json("j")).alias("ok"))
    assert df.first()["ok"] is False
