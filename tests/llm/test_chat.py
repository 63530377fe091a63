import json

from millwatch.llm import chat

CALLS = "conv_id bigint, call_id string, turn bigint, name string, arguments string, after string, status string"
RESULTS = "conv_id bigint, call_id string, turn bigint, content string, depth int"
TOOLS = "tool string, name string, type string, required boolean"


def run(spark, calls, results, tools=(("f", "a", "BIGINT", True), ("f", "b", "STRING", False))):
    rows = chat.link(
        spark.createDataFrame([(*c, "x") for c in calls], CALLS),
        spark.createDataFrame([(*r, 0) for r in results], RESULTS),
        spark.createDataFrame(list(tools), TOOLS),
    ).collect()
    return {(r.conv_id, r.call_id): r for r in rows}, rows


def test_links_order_and_canonical_json(spark):
    found, _ = run(
        spark,
        [(1, "c1", 0, "f", '{"b": "x\\n\\u00e9",  "a": 1}', None), (1, "c2", 2, "f", '{"a":2}', "c1"), (1, "c3", 4, "f", '{"a":3}', "c2"), (2, "c1", 0, "f", '{"a":4}', "gone")],
        [(1, "c1", 1, "r1"), (1, "c3", 5, 'say "hi"'), (3, "c9", 1, "stray")],
    )
    assert {k: (r.depth, r.status) for k, r in found.items()} == {
        (1, "c1"): (1, "linked"), (1, "c2"): (2, "no_result"), (1, "c3"): (3, "linked"),
        (2, "c1"): (1, "no_result"), (3, "c9"): (None, "no_call"),
    }
    text = found[1, "c1"].json
    assert text == '{"arguments":{"a":1,"b":"x\\né"},"call_id":"c1","content":"r1","errors":[],"name":"f","status":"linked"}'
    for r in found.values():
        assert json.dumps(json.loads(r.json), sort_keys=True, separators=(",", ":"), ensure_ascii=False) == r.json


def test_validation(spark):
    bad = {
        "1": ('{"a":1,"b":"s"}', []), "2": ('{"b":"s"}', ["missing a"]), "3": ('{"a":"1"}', ["a is not BIGINT"]),
        "4": ('{"a":1,"c":[1,{"z":1,"y":2}]}', ["unknown c"]), "5": ("[1]", ["not an object"]), "6": (None, ["not an object"]),
        "7": ("no json", ["not an object"]), "8": ('{"a":null}', ["a is not BIGINT"]), "9": ("", ["not an object"]),
    }
    calls = [(1, k, int(k), "f", a, None) for k, (a, _) in bad.items()] + [(1, "10", 10, "g", "{}", None)]
    found, _ = run(spark, calls, [])
    for k, (_, want) in bad.items():
        assert json.loads(found[1, k].json)["errors"] == want and found[1, k].n_errors == len(want), k
    assert json.loads(found[1, "10"].json)["errors"] == ["unknown tool"]
    assert '"c":[1,{"y":2,"z":1}]' in found[1, "4"].json


def test_long_chains_and_cycles(spark):
    calls = [(1, f"c{i}", i, "f", '{"a":1}', f"c{i - 1}") for i in range(300)]
    calls += [(2, "x", 0, "f", '{"a":1}', "y"), (2, "y", 1, "f", '{"a":1}', "x"), (2, "z", 2, "f", '{"a":1}', "x"), (2, "s", 3, "f", '{"a":1}', "s")]
    found, rows = run(spark, calls, [])
    assert len(rows) == 304
    assert all(found[1, f"c{i}"].depth == i + 1 for i in range(300))
    assert {found[2, c].status for c in "xyzs"} == {"cyclic"}


def test_odd_rows(spark):
    calls = [(None, "c", 0, "f", '{"a":1}', None), (1, None, 0, "f", '{"a":1}', None), (1, "d", 3, "f", '{"a":3}', None), (1, "d", 1, "f", '{"a":1}', None), (1, "e", None, None, None, "d"), (1, "l", 1, "f", '{"a":1,"b":"' + "x" * 100000 + '"}', None)]
    results = [(1, "d", 4, "late"), (1, "d", 2, "early"), (None, "c", 1, "n"), (1, None, 1, None), (1, "e", 9, None)]
    found, rows = run(spark, calls, results)
    assert len(rows) == 7
    d = found[1, "d"]
    assert (d.turn, d.result_turn, d.n_repeated) == (1, 2, 2) and json.loads(d.json)["content"] == "early"
    assert found[1, "e"].status == "linked" and found[1, "e"].depth == 2
    assert sorted(r.status for r in rows if r.conv_id is None or r.call_id is None) == ["no_call", "no_call", "no_result", "no_result"]
    assert len(found[1, "l"].json) > 100000
    assert run(spark, [], [])[1] == []
