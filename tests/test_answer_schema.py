from claimlake.plans.answer_schema import declared, problems, with_reasoning

SCHEMA = {"type": "object", "required": ["n"], "additionalProperties": False, "properties": {"n": {"type": "integer"}, "k": {"enum": ["a", "b"]}, "xs": {"type": "array", "items": {"type": "object", "properties": {"y": {"type": ["number", "null"]}}}}}}


def test_problems():
    assert problems({"n": 1, "k": "a", "xs": [{"y": 1.5}, {"y": None}]}, SCHEMA) == []
    assert problems({"n": True}, SCHEMA) == ["$.n: not integer"]
    assert problems({"k": "c", "z": 1}, SCHEMA) == ["$.n: missing", "$.z: not declared", "$.k: 'c' is not one of ['a', 'b']"]
    assert problems({"n": 1, "xs": [{"y": "s"}]}, SCHEMA) == ["$.xs[0].y: not number or null"]
    assert problems([], SCHEMA) == ["$: not object"]


def test_declared_and_reasoning():
    assert declared(SCHEMA) == {"n", "k", "xs", "y"}
    more = with_reasoning(SCHEMA)
    assert list(more["properties"])[0] == "reasoning" and more["required"] == ["reasoning", "n"] and with_reasoning(more) is more
