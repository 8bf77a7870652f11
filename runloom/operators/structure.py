"""Operators over JSON structure: state diff, contract checks, checksums."""

from __future__ import annotations

import json
import re
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from runloom.functions import text as T

LEAF = StructType([StructField("path", StringType()), StructField("kind", StringType()), StructField("value", StringType())])


def leaves(value: Any, path: str = "$") -> list[tuple[str, str, str]]:
    """(path, kind, JSON) of scalars and empty containers, lists by position."""
    if isinstance(value, dict) and value:
        return [x for k in sorted(value) for x in leaves(value[k], f"{path}.{k}")]
    if isinstance(value, list) and value:
        return [x for i, v in enumerate(value) for x in leaves(v, f"{path}[{i}]")]
    kind = {dict: "object", list: "array", str: "string", bool: "boolean", type(None): "null"}.get(type(value), "number")
    return [(path, kind, json.dumps(value, sort_keys=True, ensure_ascii=False))]


@F.pandas_udf(ArrayType(LEAF))
def leaf_rows(text: pd.Series) -> pd.Series:
    """Leaves of JSON documents; null for text that is not JSON."""

    def one(t: str | None):
        try:
            return [dict(zip(("path", "kind", "value"), x, strict=True)) for x in leaves(json.loads(t))]
        except (TypeError, ValueError):
            return None

    return text.map(one)


def state_diff(states: DataFrame, key: str, before: str, after: str) -> DataFrame:
    """``(key, path, change, before_value, after_value)``: leaves that were added, removed or changed.

    Both sides of a row are flattened and compared by path: one row on each side
    of one group, so a single shuffle by (key, path) serves all documents. Where
    a container became another kind of value, its leaves' places differ; the
    shorter path is one change and what lies below it is not listed.
    """
    side = lambda c, n: states.filter(F.col(before) != F.col(after)).select(key, F.lit(n).alias("side"), F.inline(leaf_rows(F.col(c))))
    both = side(before, 0).unionAll(side(after, 1)).groupBy(key, "path").agg(
        F.max(F.when(F.col("side") == 0, F.col("value"))).alias("before_value"), F.max(F.when(F.col("side") == 1, F.col("value"))).alias("after_value")
    )
    changed = both.filter(~F.col("before_value").eqNullSafe(F.col("after_value")))
    change = F.when(F.col("before_value").isNull(), "added").when(F.col("after_value").isNull(), "removed").otherwise("changed")
    return changed.withColumn("change", change)


def diff_status(states: DataFrame, key: str, before: str, after: str, budget: int = 1000) -> DataFrame:
    """changed, unchanged, or unknown where a side is missing or is not JSON; the count of changes and whether it is over the budget."""
    rows = state_diff(states, key, before, after).groupBy(key).agg(F.count("*").alias("changes"))
    known = F.try_parse_json(before).isNotNull() & F.try_parse_json(after).isNotNull()
    both = states.select(key, known.alias("known")).join(rows, key, "left")
    status = F.when(~F.coalesce("known", F.lit(False)), "unknown").when(F.coalesce("changes", F.lit(0)) > 0, "changed").otherwise("unchanged")
    return both.select(key, status.alias("status"), F.coalesce("changes", F.lit(0)).alias("changes"), (F.coalesce("changes", F.lit(0)) > budget).alias("truncated"))


KINDS = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}


def _is(value: Any, kind: str) -> bool:
    if kind == "integer":
        return isinstance(value, int) and not isinstance(value, bool) or isinstance(value, float) and value.is_integer()
    if kind == "number":
        return isinstance(value, int | float) and not isinstance(value, bool)
    return isinstance(value, KINDS[kind])


def same(a: Any, b: Any) -> bool:
    """JSON equality: numbers by value, but a boolean is never a number."""
    if isinstance(a, bool) or isinstance(b, bool):
        return isinstance(a, bool) and isinstance(b, bool) and a == b
    if isinstance(a, dict) and isinstance(b, dict):
        return a.keys() == b.keys() and all(same(v, b[k]) for k, v in a.items())
    if isinstance(a, list) and isinstance(b, list):
        return len(a) == len(b) and all(map(same, a, b))
    return a == b


def schema_errors(value: Any, schema: dict, root: dict | None = None, at: str = "$") -> list[str]:
    """All violations of a JSON-Schema subset, as 'path: what'."""
    root = root or schema
    if "$ref" in schema:
        node: Any = root
        for part in schema["$ref"].lstrip("#/").split("/"):
            node = node[part]
        return schema_errors(value, node, root, at)
    out: list[str] = []
    for s in schema.get("allOf", []):
        out += schema_errors(value, s, root, at)
    if "anyOf" in schema and all(schema_errors(value, s, root, at) for s in schema["anyOf"]):
        out.append(f"{at}: matches none of anyOf")
    if "oneOf" in schema and sum(not schema_errors(value, s, root, at) for s in schema["oneOf"]) != 1:
        out.append(f"{at}: does not match exactly one of oneOf")
    if "if" in schema and not schema_errors(value, schema["if"], root, at):
        out += schema_errors(value, schema.get("then", {}), root, at)
    if "const" in schema and not same(value, schema["const"]):
        out.append(f"{at}: is not the constant")
    if "enum" in schema and not any(same(value, e) for e in schema["enum"]):
        out.append(f"{at}: is not in the enumeration")
    kinds = schema.get("type")
    if kinds and not any(_is(value, k) for k in ([kinds] if isinstance(kinds, str) else kinds)):
        return [*out, f"{at}: is not of type {kinds if isinstance(kinds, str) else '|'.join(kinds)}"]
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{at}.{k}: is missing" for k in schema.get("required", []) if k not in value]
        extra = schema.get("additionalProperties", True)
        for k, v in value.items():
            if k in known:
                out += schema_errors(v, known[k], root, f"{at}.{k}")
            elif extra is False:
                out.append(f"{at}.{k}: is not allowed")
            elif isinstance(extra, dict):
                out += schema_errors(v, extra, root, f"{at}.{k}")
    if isinstance(value, list):
        for i, v in enumerate(value if "items" in schema else []):
            out += schema_errors(v, schema["items"], root, f"{at}[{i}]")
        if len(value) < schema.get("minItems", 0):
            out.append(f"{at}: has too few items")
        if len(value) > schema.get("maxItems", len(value)):
            out.append(f"{at}: has too many items")
        if schema.get("uniqueItems") and any(same(a, b) for i, a in enumerate(value) for b in value[:i]):
            out.append(f"{at}: items repeat")
    if isinstance(value, str):
        if len(value) < schema.get("minLength", 0):
            out.append(f"{at}: is too short")
        if len(value) > schema.get("maxLength", len(value)):
            out.append(f"{at}: is too long")
        if "pattern" in schema and not re.search(schema["pattern"], value):
            out.append(f"{at}: does not match the pattern")
    if isinstance(value, int | float) and not isinstance(value, bool):
        if value != value or value in (float("inf"), float("-inf")):
            out.append(f"{at}: is not finite")
        for name, bad in (("minimum", lambda b: value < b), ("maximum", lambda b: value > b), ("exclusiveMinimum", lambda b: value <= b), ("exclusiveMaximum", lambda b: value >= b)):
            if name in schema and bad(schema[name]):
                out.append(f"{at}: breaks {name}")
    return out


def contract_errors(text: Column, schema: dict) -> Column:
    """Array of violations for each JSON text; text that is not JSON is one violation."""

    @F.pandas_udf(ArrayType(StringType()))
    def run(s: pd.Series) -> pd.Series:
        def one(t):
            try:
                return schema_errors(json.loads(t), schema)
            except (TypeError, ValueError):
                return ["$: is not JSON"]

        return s.map(one)

    return run(text)


def checksum(rows: DataFrame, group: str, parts: list[str]) -> DataFrame:
    """An order-free checksum of each group's rows.

    Row hashes are added as 256-bit numbers in four parts, which combine before
    the shuffle; a hash of a sorted list would gather the group in one task.
    """
    h = F.sha2(F.to_json(F.struct(*parts)), 256)
    four = [F.conv(F.substring(h, 1 + 15 * i, 15), 16, 10).cast("decimal(38,0)") for i in range(4)]
    sums = rows.groupBy(group).agg(F.count("*").alias("n"), *[F.sum(x).alias(f"s{i}") for i, x in enumerate(four)])
    return sums.select(group, "n", F.sha2(F.concat_ws(":", F.col("n").cast("string"), *[F.col(f"s{i}").cast("string") for i in range(4)]), 256).alias("checksum"))


def forbidden_text(rows: DataFrame, key: str, text: str, literals: list[str]) -> DataFrame:
    """Which forbidden literals each text holds."""
    hits = F.array_compact(F.array(*[F.when(F.contains(F.col(text), F.lit(x)), x) for x in literals]))
    return rows.select(key, F.explode(hits).alias("literal"))


def evidence_links(rules: DataFrame, key: str) -> DataFrame:
    """One row for each item of each rule that points at an event."""
    return rules.select(key, F.posexplode("items").alias("position", "x")).filter("x.event_index is not null").select(key, "x.rule_id", "x.item_id", "position", "x.event_index")


def task_contract(prompt: Column, system: Column, tools: Column) -> Column:
    """Fingerprint of what a task asks: SHA-256 of canonical JSON of the normalised prompt, system texts and tool names."""
    fields = F.struct(T.normalise(F.coalesce(prompt, F.lit(""))).alias("prompt"), F.coalesce(system, F.array().cast("array<string>")).alias("system"), F.array_sort(F.coalesce(tools, F.array().cast("array<string>"))).alias("tools"))
    return F.sha2(F.to_json(fields), 256)


def identity_key(*parts: Column) -> Column:
    """A key that tells null from empty and never runs parts together: lengths before texts."""
    told = [F.coalesce(F.concat(F.length(p.cast("string")).cast("string"), F.lit(":"), p.cast("string")), F.lit("-")) for p in parts]
    return F.concat_ws("|", *told)


def assign_path(text: Column, path: tuple[str, ...], value: Column) -> Column:
    """JSON objects with ``value`` (JSON text) at a path of names; objects on the way are made, other kinds on it replaced.

    Names stay in order with a new one last; text that is no object counts as
    the empty one.
    """
    kind = "map<string,variant>"
    entries = F.coalesce(F.map_entries(F.try_variant_get(F.try_parse_json(text), "$", kind)), F.array().cast("array<struct<key:string,value:variant>>"))
    head, rest = path[0], path[1:]
    own = F.to_json(F.get(F.filter(entries, lambda e: e["key"] == head), 0)["value"]) if rest else None
    new = assign_path(F.coalesce(own, F.lit("{}")), rest, value) if rest else value
    names = F.transform(F.filter(entries, lambda e: e["key"] != head), lambda e: F.concat(_quoted(e["key"]), F.lit(":"), F.to_json(e["value"])))
    return F.concat(F.lit("{"), F.array_join(F.concat(names, F.array(F.concat(_quoted(F.lit(head)), F.lit(":"), new))), ","), F.lit("}"))


def _quoted(name: Column) -> Column:
    """A name in JSON, out of an object of one field."""
    told = F.to_json(F.struct(name.alias("k")))
    return F.substring(told, F.lit(6), F.length(told) - 6)


def summary(passed: Column, score: Column, critical: Column) -> Column:
    """One sentence on a scorecard; the wording is a fixed value of the contract."""
    said = score.cast("string")
    return (
        F.when(passed, F.concat(F.lit("PASS: score "), said, F.lit(", no critical failures.")))
        .when(F.size(critical) > 0, F.concat(F.lit("FAIL: score "), said, F.lit(", critical failures: "), F.array_join(critical, ", "), F.lit(".")))
        .otherwise(F.concat(F.lit("FAIL: score "), said, F.lit(" below threshold.")))
    )


def bounded(rows: DataFrame, most: int, *order: Column | str) -> DataFrame:
    """The first ``most`` rows of a report in an order, each with how many there are in all; the bound is the report's feature."""
    total = rows.agg(F.count("*").alias("total"))
    return rows.orderBy(*order).limit(most).crossJoin(F.broadcast(total)).withColumn("truncated", F.col("total") > most)  # one row
