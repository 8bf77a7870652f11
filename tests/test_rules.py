import pytest
from pyspark.sql import functions as F

from runloom.functions.predicates import PredicateError
from runloom.operators import rules as R, traces as T


def run(spark, events, scenario, final="done"):
    rows = spark.createDataFrame([("r", i, *e) for i, e in enumerate(events)], "run_id string, event_index long, event_type string, tool_name string, status string, text string")
    runs = spark.createDataFrame([("r", final)], "run_id string, final_answer string")
    return R.evaluate(rows, runs, scenario)


def items(df):
    return {x["item_id"]: (x["passed"], x["event_index"]) for x in df.first()["items"]}


CALL, RESULT, ASK = ("tool_call", "mail", "ok", "send to a@b"), ("tool_result", "mail", "ok", "sent"), ("user_message", None, None, "please\nsend")


def test_sequence_is_greedy_and_ordered(spark):
    steps = [{"event_type": "user_message"}, {"event_type": "tool_call"}, {"event_type": "tool_result"}]
    s = {"assertions": {"required_action_sequences": [{"id": "s", "steps": steps}]}}
    assert items(run(spark, [ASK, CALL, CALL, RESULT], s))["s"] == (True, 3)
    assert items(run(spark, [RESULT, CALL, ASK], s))["s"] == (False, None)
    assert items(run(spark, [ASK, CALL], s))["s"] == (False, None)


def test_counts_budget_and_final(spark):
    s = {"policy": {"max_tool_calls": 1}, "assertions": {"required_event_counts": [{"id": "c", "event_type": "tool_call", "exact_count": 2}], "final_contains": ["DONE"], "final_not_contains": ["error"]}}
    got = R.scorecards(run(spark, [CALL, CALL], s)).first()
    assert got["failed_rules"] == ["budget"] and got["score"] == 75 and not got["passed"] and got["completion"] == "complete"


def test_no_items_pass_and_floor_at_zero(spark):
    assert R.scorecards(run(spark, [ASK], {})).first()["score"] == 100
    s = {"policy": {"forbidden_tool_names": ["ma.l"], "secret_patterns": ["send.to|please.send"], "max_tool_calls": 0}, "assertions": {"final_contains": ["nothing"], "required_actions": [{"id": "a", "event_type": "x"}]}}
    got = R.scorecards(run(spark, [CALL], s)).first()
    assert got["score"] == 0 and len(got["failed_rules"]) == 5


def test_secret_pattern_spans_lines(spark):
    s = {"policy": {"secret_patterns": ["please.send"]}}
    assert R.scorecards(run(spark, [ASK], s)).first()["failed_rules"] == ["secret_exposure"]


def test_bad_scenarios_fail_before_reading():
    for bad in ({"assertions": {"required_actions": [{"event_type": "x"}]}}, {"assertions": {"required_action_sequences": [{"id": "s", "steps": []}]}}, {"assertions": {"required_event_counts": [{"id": "c"}]}}, {"scoring": {"pass_threshold": 101}}):
        with pytest.raises(PredicateError):
            R.check_scenario(bad)


def test_run_without_events(spark):
    rows = spark.createDataFrame([], "run_id string, event_index long, event_type string, tool_name string, status string, text string")
    runs = spark.createDataFrame([("r", None)], "run_id string, final_answer string")
    out = R.evaluate(rows, runs, {"assertions": {"required_actions": [{"id": "a", "event_type": "x"}], "required_event_counts": [{"id": "c", "event_type": "x", "max_count": 0}]}})
    assert items(out)["a"] == (False, None) and items(out)["c"][0]


def test_depth_survives_cycles(spark):
    rows = [("r", "b", "a"), ("r", "c", "b"), ("r", "a", "c"), ("q", "y", "x"), ("q", "z", "y"), ("q", None, "x")]
    df = spark.createDataFrame(rows, "run_id string, session_id string, parent_session_id string")
    assert {r["run_id"]: r["max_depth"] for r in R.subagent_depth(df).collect()} == {"r": 2, "q": 2}


def test_mixed_call_matching(spark):
    rows = [("r", 0, "tool_call", "t", "1"), ("r", 1, "tool_call", "t", "2"), ("r", 2, "tool_result", "t", "2"), ("r", 3, "tool_result", "t", None), ("r", 4, "tool_result", "t", None)]
    df = spark.createDataFrame(rows, "run_id string, event_index long, event_type string, tool_name string, tool_call_id string")
    got = {(r["call_index"], r["result_index"]) for r in T.match_calls_mixed(df).collect()}
    assert got == {(1, 2), (0, 3), (None, 4)}


def test_observability_of_nothing(spark):
    empty = spark.createDataFrame([], "run_id string, event_index long, event_type string, text string")
    row = T.observability_metrics(T.trace_signal(empty)).first()
    assert row["run_count"] == 0 and row["average_event_count"] == 0.0


def test_rules_and_scores_agree(spark):
    s = {"policy": {"max_tool_calls": 1}}
    e = run(spark, [CALL, CALL], s)
    failed = R.rule_rows(e).filter(~F.col("passed")).collect()
    assert [r["rule_id"] for r in failed] == ["budget"] and failed[0]["penalty"] == 25
