"""The predicate language of scenario contracts, compiled to Spark columns.

An item such as ``{"event_type": "tool_call", "where": {"args.to": {"contains": "@"}}}``
becomes one boolean ``Column`` that is built once for a scenario and evaluated by
Catalyst. Fields that are ordinary columns are used as such; any other dotted path
is read from a VARIANT column, where a missing path (SQL NULL) and a JSON null
stay apart. ``*`` in a path ranges over the values of an object or list and a
constraint then holds if it holds for any of them.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import Column, functions as F

OPERATORS = ("equals", "contains", "matches", "present")


class PredicateError(ValueError):
    """A predicate that cannot be compiled; raised before any data is read."""


def spaced_json(compact: Column) -> Column:
    """Compact JSON with a space after each separator that stands outside of strings.

    A zero byte, which JSON text never holds, marks the ends of strings and the
    separators; those after a string's quote go, the others become spaces.
    """
    marked = F.regexp_replace(compact, r'("(?:[^"\\]|\\.)*+")|([,:])', "$1$2\x00")
    return F.replace(F.replace(marked, F.lit('"\x00'), F.lit('"')), F.lit("\x00"), F.lit(" "))


def json_text(value: Column) -> Column:
    """A VARIANT as text: strings as they are, null and missing empty, anything else as sorted JSON."""
    kind = F.schema_of_variant(value)
    simple = F.when(kind == "STRING", F.try_variant_get(value, "$", "string")).when(F.is_variant_null(value), "")
    container = kind.startswith("OBJECT") | kind.startswith("ARRAY")
    return F.coalesce(simple.when(container, spaced_json(F.to_json(value))).otherwise(F.to_json(value)), F.lit(""))


def text_constraint(item: Mapping[str, Any]) -> dict[str, Any] | None:
    """The single text matcher of an item: equals, then contains, then matches, then pattern."""
    for name in ("equals", "contains", "matches", "pattern"):
        if name in item:
            return {"matches" if name == "pattern" else name: item[name]}
    return None


def constraints(item: Mapping[str, Any]) -> dict[str, Any]:
    """All field constraints of an item; later sources overwrite earlier ones."""
    out = dict(item["where"]) if isinstance(item.get("where"), Mapping) else {}
    for source, operator in (("field_equals", "equals"), ("field_contains", "contains"), ("field_matches", "matches")):
        for name, expected in (item.get(source) or {}).items():
            out[str(name)] = {operator: expected}
    single = text_constraint(item)
    if single is not None:
        out[str(item.get("field") or "all")] = single
    return out


def _step(value: Column, part: str) -> Column:
    """A member of a VARIANT: by key of an object, or by index of a list where the part is a number."""
    key = part.replace("'", "\\'")
    found = F.try_variant_get(value, f"$['{key}']", "variant")
    return F.coalesce(found, F.try_variant_get(value, f"$[{int(part)}]", "variant")) if part.isdigit() else found


def members(value: Column) -> Column:
    """Values of a list or object as an array of VARIANT; a scalar has none."""
    return F.coalesce(F.try_variant_get(value, "$", "array<variant>"), F.map_values(F.try_variant_get(value, "$", "map<string,variant>")), F.array().cast("array<variant>"))


def path(value: Column, parts: list[str]) -> tuple[Column, bool]:
    """(column, whether it is an array of all values that a wildcard ranges over)."""
    if "*" not in parts:
        for p in parts:
            value = _step(value, p)
        return value, False

    def spread(v: Column, rest: list[str]) -> Column:
        if not rest:
            return F.when(v.isNull(), F.array().cast("array<variant>")).otherwise(F.array(v))
        if rest[0] == "*":
            return F.flatten(F.transform(members(v), lambda x: spread(x, rest[1:])))
        return spread(_step(v, rest[0]), rest[1:])

    return spread(value, parts), True


def _equals_variant(value: Column, expected: Any) -> Column:
    """Equality by value: numbers and booleans compare as numbers, null with null, containers as canonical JSON."""
    kind = F.schema_of_variant(value)
    if expected is None:
        return F.coalesce(F.is_variant_null(value), F.lit(False))
    if isinstance(expected, str):
        return F.coalesce((kind == "STRING") & (F.try_variant_get(value, "$", "string") == expected), F.lit(False))
    if isinstance(expected, bool | int | float):
        number = (kind == "BOOLEAN") | (kind == "BIGINT") | (kind == "DOUBLE") | (kind == "FLOAT") | kind.startswith("DECIMAL")
        return F.coalesce(number & (F.try_variant_get(value, "$", "double") == float(expected)), F.lit(False))
    return F.coalesce(F.to_json(value) == F.to_json(F.parse_json(F.lit(json.dumps(expected)))), F.lit(False))


def _holds(value: Column, constraint: Any, variant: bool) -> Column:
    """Whether one value, NULL if missing, meets a constraint."""
    text = json_text(value) if variant else F.coalesce(value.cast("string"), F.lit(""))
    equal = (lambda e: _equals_variant(value, e)) if variant else (lambda e: value.isNull() if e is None else F.coalesce(value == F.lit(e), F.lit(False)))
    if not (isinstance(constraint, Mapping) and any(o in constraint for o in OPERATORS)):
        return value.isNotNull() & equal(constraint)
    out = F.lit(True)
    if "present" in constraint:
        out = out & (value.isNotNull() if constraint["present"] else value.isNull())
    if "equals" in constraint:
        out = out & equal(constraint["equals"])
    if "contains" in constraint:
        out = out & value.isNotNull() & F.contains(text, F.lit(str(constraint["contains"])))
    if "matches" in constraint:
        out = out & value.isNotNull() & text.rlike("(?s)" + str(constraint["matches"]))
    return out


def holds(field: str, constraint: Any, columns: Mapping[str, Column], variant: Column | None = None) -> Column:
    """Whether the field of a row meets a constraint."""
    if field in columns:
        return _holds(columns[field], constraint, False)
    if variant is None:
        raise PredicateError(f"no column and no document for the field {field!r}")
    if field == "all":
        return _holds(spaced_json(F.to_json(variant)), constraint, False)
    value, wild = path(variant, field.split("."))
    if not wild:
        return _holds(value, constraint, True)
    if isinstance(constraint, Mapping) and "present" in constraint:
        present = F.size(value) > 0 if constraint["present"] else F.size(value) == 0
        rest = {k: v for k, v in constraint.items() if k != "present"}
        return present & F.exists(value, lambda x: _holds(x, rest, True)) if rest else present
    return F.exists(value, lambda x: _holds(x, constraint, True))


def _meets(where: Mapping[str, Any]) -> Callable[[Column], Column]:
    """Whether one VARIANT is an object that meets all constraints."""

    def good(x: Column) -> Column:
        ok = F.schema_of_variant(x).startswith("OBJECT")
        for name, constraint in where.items():
            ok = ok & holds(name, constraint, {}, x)
        return ok

    return good


def where_any(item: Mapping[str, Any], variant: Column) -> Column:
    """All checks must find one object in their collection that meets all of its constraints at once."""
    checks = item.get("where_any")
    if checks is None:
        return F.lit(True)
    out = F.lit(True)
    for check in checks if isinstance(checks, list) else [checks]:
        if not isinstance(check, Mapping) or not isinstance(check.get("path"), str) or not check.get("where"):
            return F.lit(False)
        value, wild = path(variant, check["path"].split("."))
        inside = value if wild else F.when(value.isNull(), F.array().cast("array<variant>")).otherwise(
            F.coalesce(F.try_variant_get(value, "$", "array<variant>"), F.map_values(F.try_variant_get(value, "$", "map<string,variant>")), F.array(value))
        )

        out = out & F.exists(inside, _meets(check["where"]))
    return out


def event_predicate(item: Mapping[str, Any], columns: Mapping[str, Column], variant: Column | None = None) -> Column:
    """An event predicate: type, tool and status by equality, and all field constraints."""
    out = F.lit(True)
    for name in ("event_type", "tool_name", "status"):
        if item.get(name) is not None:
            out = out & F.coalesce(columns[name] == F.lit(item[name]), F.lit(False))
    for field, constraint in constraints(item).items():
        out = out & holds(field, constraint, columns, variant)
    return out


def text_predicate(item: Mapping[str, Any], text: Column) -> Column:
    """The text matcher of an item over one string column; null counts as empty."""
    single = text_constraint(item) or {"matches": ""}
    return _holds(F.coalesce(text, F.lit("")), single, False)


def state_predicate(item: Mapping[str, Any], state: Column) -> Column:
    """A predicate over a VARIANT snapshot; a missing snapshot fails."""
    out = state.isNotNull() & where_any(item, state)
    for field, constraint in constraints(item).items():
        out = out & holds(field, constraint, {}, state)
    return F.coalesce(out, F.lit(False))
