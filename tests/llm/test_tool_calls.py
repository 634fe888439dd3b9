import json

import pytest
from pyspark.sql import functions as F

from pickwise.llm import tool_calls as C

CALLS = "conv_id bigint, turn bigint, call_id string, name string, arguments string, depends_on array<string>"
RESULTS = "conv_id bigint, turn bigint, call_id string, content string"


def linked(spark, calls, results, schemas=None):
    c = spark.createDataFrame(calls, CALLS).withColumn("status", F.lit("x")).withColumn("layer", F.lit("y"))
    r = spark.createDataFrame(results, RESULTS).withColumn("r", F.lit("z"))
    return C.link(c, r, schemas or {}).collect()


def test_order_follows_dependencies(spark):
    calls = [
        (1, 0, "a", "f", "{}", ["c"]), (1, 1, "b", "f", "{}", []), (1, 2, "c", "f", "{}", ["b", "gone"]),  # forward reference
        (2, 0, "d", "f", "{}", []), (2, 4, "e", "f", "{}", ["d"]),  # already in order
        (3, 0, "x", "f", "{}", ["y"]), (3, 1, "y", "f", "{}", ["x"]), (3, 2, "z", "f", "{}", ["y"]), (3, 3, "w", "f", "{}", None),  # a cycle
    ]
    got = {r.call_id: r for r in linked(spark, calls, [])}
    assert got["b"].order_key < got["c"].order_key < got["a"].order_key
    assert (got["d"].order_key, got["e"].order_key) == (0, 4)
    assert [got[k].status for k in "xyzw"] == ["cycle"] * 3 + ["unanswered"]
    assert got["w"].order_key < min(got[k].order_key for k in "xyz")
    assert json.loads(got["c"].message)["depends_on"] == ["b", "gone"]


def test_layers_against_plain_longest_paths(spark):
    import random

    r, calls, above = random.Random(0), [], {}
    order = r.sample(range(40), 40)
    for k, v in enumerate(order):
        needs = r.sample(order[:k], min(k, r.randint(0, 2)))
        above[v] = needs
        calls.append((1, v, str(v), "f", "{}", [str(x) for x in needs]))
    depth = lambda v: max((depth(x) + 1 for x in above[v]), default=0)
    got = {r.call_id: r.order_key for r in linked(spark, calls, [])}
    assert got == {str(v): depth(v) for v in order}


def test_links_duplicates_and_orphans(spark):
    calls = [(1, 0, "a", "f", "{}", []), (1, 0, "a", "f", "{}", []), (1, 2, "b", "f", "{}", []), (1, 3, "b", "f", '{"x":1}', []), (None, None, None, "f", None, None), (1, 5, "c", None, None, None)]
    results = [(1, 9, "a", "late"), (1, 1, "a", "early"), (1, 1, "a", "early"), (7, 1, "lost", None), (None, None, None, None)]
    got = linked(spark, calls, results)
    assert sorted((str(r.call_id), r.status) for r in got) == [("None", "no_id"), ("None", "orphan"), ("a", "answered"), ("b", "duplicate_id"), ("b", "duplicate_id"), ("c", "unanswered"), ("lost", "orphan")]
    assert json.loads(next(r for r in got if r.call_id == "a").message)["result"] == "early"
    assert linked(spark, [], []) == []


def test_arguments_are_checked_against_schemas(spark):
    schema = {"f": {"properties": {"n": {"type": "integer", "minimum": 1, "maximum": 5}, "s": {"type": ["string", "null"], "maxLength": 3}, "l": {"type": "array", "items": {"enum": [1, "a"]}, "minItems": 1}}, "required": ["n"], "additionalProperties": False}}
    cases = {
        '{"n":3,"s":"abc","l":[1,"a"]}': "", '{"n":3.0,"s":null}': "", '{"n":true}': "$.n: not integer", "{}": "$.n: missing", '{"n":9}': "$.n: above 5",
        '{"n":1,"s":"abcd"}': "$.s: longer than 3", '{"n":1,"l":[2]}': "$.l[0]: not in enum", '{"n":1,"l":[]}': "$.l: shorter than 1", '{"n":1,"q":0}': "$.q: unknown",
        "[1]": "$: not object", "{": "$: not JSON", '{"n":NaN}': "$: not JSON", '{"n":1e999}': "$: not JSON",
    }
    calls = [(1, i, str(i), "f", a, []) for i, a in enumerate(cases)]
    got = {r.turn: r for r in linked(spark, calls, [], schema)}
    for i, want in enumerate(cases.values()):
        assert got[i].errors == want and got[i].valid == (want == "")


@pytest.mark.parametrize(
    ("value", "want"),
    [
        ({"b": 1, "a": [True, None]}, '{"a":[true,null],"b":1}'), ({"é": 1.0, "z": 1e21, "😀": 0.1, "דּ": -0.0}, '{"z":1e+21,"é":1,"😀":0.1,"דּ":0}'),
        (1e-7, "1e-7"), (123456789012345680000.0, "123456789012345683968"), ("a\n\"€\u0007", '"a\\n\\"€\\u0007"'), ({}, "{}"),
    ],
)
def test_canonical_json(value, want):
    assert C.canonical(value) == want and json.loads(want) == value


def test_lone_surrogates_are_escaped(spark):
    texts = ['{"a":"\\ud800"}', '{"\\udfff":["x\\ud83d\\ude00y\\ud83d"]}', '{"q":1,"\\ud801":2}']
    calls = [(1, i, str(i), "f" if i < 2 else "g", t, []) for i, t in enumerate(texts)]
    got = {r.turn: r for r in linked(spark, calls, [], {"g": {"properties": {"q": {}}, "additionalProperties": False}})}
    assert '"arguments":{"a":"\\ud800"}' in got[0].message and '{"\\udfff":["x😀y\\ud83d"]}' in got[1].message
    assert got[2].errors == "$.\\ud801: unknown" and not got[2].valid
    for i, t in enumerate(texts):
        assert json.loads(got[i].message)["arguments"] == json.loads(t)


def test_a_long_chain_is_ordered_in_one_task(spark):
    import time

    n = 1000
    calls = [(1, n - i, str(i), "f", "{}", [str(i - 1)] if i else []) for i in range(n)]
    # a tie between two conversations: ordered by rounds
    calls += [(2, 1, "x", "f", "{}", ["y"]), (2, 2, "y", "f", "{}", ["z"]), (3, 0, "z", "f", "{}", []), (4, 1, "p", "f", "{}", ["q"]), (4, 2, "q", "f", "{}", ["p"])]
    began = time.perf_counter()
    got = {r.call_id: r for r in linked(spark, calls, [])}
    assert time.perf_counter() - began < 60
    assert all(got[str(i)].order_key == i for i in range(n))
    assert [got[c].order_key for c in "zyx"] == [0, 0, 1]  # layers are counted within a conversation
    assert got["p"].status == got["q"].status == "cycle"


def test_conversations_against_sql(spark, sf_small):
    from oracle_compare import compare

    got = compare(spark, sf_small, ["op10_tool_calls"], verbose=False)["op10_tool_calls"]
    assert got["hash_match"] and got["cols_match"] and got["types_match"]
