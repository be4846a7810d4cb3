"""The loop over a text's marks against the JSON reader and a recursive walk."""

import json
import random

import pytest

from tickloom.operators import schema_merge as sm
from tickloom.operators.deep_json import document_types


def types_of(text):
    return sorted(document_types(text, sm.WRAPPED, "/", "*"))


def walk(value, path="", root=""):
    if isinstance(value, dict):
        if len(value) == 1 and next(iter(value)) in sm.WRAPPED:
            return [(path, root, sm.WRAPPED[next(iter(value))])]
        inner = root or (path if path.endswith("/*") else "")
        return [x for k, v in value.items() for x in walk(v, f"{path}/{k}", inner)] + ([(path, root, "struct")] if path else [])
    if isinstance(value, list):
        return [*walk(value[0] if value else "", f"{path}/*", root), (path, root, "list")]
    kind = {bool: "boolean", float: "double", int: "int"}.get(type(value), "string")
    if kind == "int" and not -2**31 <= value < 2**31:
        kind = "long" if -2**63 <= value < 2**63 else "double"
    return [(path, root, kind)]


def test_random_documents():
    rng = random.Random(9)

    def value(depth):
        kind = rng.randrange(10 if depth else 7)
        if kind < 7:
            return [None, True, rng.choice([0, -5, 2**40, 2**70]), -2.5e3, 'q"\\u00e9\n{[', "", {"$oid": "1"}][kind]
        if kind == 7:
            return [value(depth - 1) for _ in range(rng.randrange(4))]
        return {rng.choice(["a", "b", 'c"', "$date", ""]): value(depth - 1) for _ in range(rng.randrange(4))}

    for _ in range(500):
        doc = {rng.choice("abc"): value(6) for _ in range(rng.randrange(4))}
        for text in (json.dumps(doc), json.dumps(doc, indent=2, ensure_ascii=False) + " \n"):
            assert types_of(text) == sorted(walk(doc))


@pytest.mark.parametrize("text", ["", "5", "[1]", "{", "}", '{"a"}', '{"a":}', '{"a":1,}', '{"a":1 "b":2}', '{"a":01}',
                                  '{"a":[1,]}', '{"a":[,1]}', '{,"a":1}', "{'a':1}", '{"a":tru}', '{"a":"x', '{"a":NaN}', '{"a":[1}', '{"a":{]}', '{1:2}'])
def test_other_texts_have_no_types(text):
    assert types_of(text) == []


def test_depth_and_repeated_names():
    assert sum(t == "struct" for _, _, t in types_of('{"a":' * 2_000 + "[]" + "}" * 2_000)) == 1_999
    assert types_of('{"a":{"b":1},"a":2}') == types_of('{"a":2} x') == [("/a", "", "int")]
