"""A small subset of JSON Schema, enough to hold model answers to their contract."""

from __future__ import annotations

from typing import Any

KINDS = {"string": str, "boolean": bool, "array": list, "object": dict, "null": type(None)}


def _is(value: Any, kind: str) -> bool:
    if kind == "integer":
        return isinstance(value, int) and not isinstance(value, bool)
    if kind == "number":
        return isinstance(value, (int, float)) and not isinstance(value, bool)
    return isinstance(value, KINDS[kind])


def problems(value: Any, schema: dict, at: str = "$") -> list[str]:
    """What is wrong with a value: type, enum, required and undeclared keys, items."""
    kinds = schema.get("type")
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(_is(value, k) for k in kinds):
        return [f"{at}: not {' or '.join(kinds)}"]
    out = []
    if "enum" in schema and value not in schema["enum"]:
        out.append(f"{at}: {value!r} is not one of {schema['enum']}")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{at}.{k}: missing" for k in schema.get("required", ()) if k not in value]
        if schema.get("additionalProperties") is False:
            out += [f"{at}.{k}: not declared" for k in value if k not in known]
        for k, v in value.items():
            if k in known:
                out += problems(v, known[k], f"{at}.{k}")
    if isinstance(value, list) and "items" in schema:
        for i, v in enumerate(value):
            out += problems(v, schema["items"], f"{at}[{i}]")
    return out


def declared(schema: dict) -> set[str]:
    """Every property name a schema declares, at any depth."""
    found = set(schema.get("properties", {}))
    for sub in [*schema.get("properties", {}).values(), *([schema["items"]] if "items" in schema else [])]:
        found |= declared(sub)
    return found


def with_reasoning(schema: dict) -> dict:
    """The schema with a ``reasoning`` text first, so an answer is argued before it is given."""
    known = schema.get("properties", {})
    if "reasoning" in known:
        return schema
    return {**schema, "properties": {"reasoning": {"type": "string"}, **known}, "required": ["reasoning", *schema.get("required", ())]}
