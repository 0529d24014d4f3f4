"""Tool calls linked, ordered, checked and written."""

from __future__ import annotations

import json

import pytest
from compare import connect, differences

from pulsegrid.llm import queries, tool_calls as tc

CALLS = "conv_id long, turn long, call_id string, name string, arguments string, after array<string>"
RESULTS = "conv_id long, turn long, call_id string, content string"
TOOLS = [("find", "text", "string", True), ("find", "limit", "integer", False), ("find", "score", "number", False),
         ("find", "tags", "array", False), ("find", "more", "object", False), ("find", "deep", "boolean", False)]


def link(spark, calls, results):
    frames = spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS)
    rows = tc.link(*frames, tc.schemas_table(spark, TOOLS)).collect()
    return {(r["conv_id"], r["call_id"]): r for r in rows}, len(rows)


def test_status_and_faults(spark):
    ok = '{"text": "é \\"x\\"\\n", "limit": 3, "score": 2, "tags": [1, {"b": 1, "a": 2}], "more": {"z": 1, "a": null}, "deep": true}'
    calls = [
        (1, 1, "a", "find", ok, []), (1, 2, "b", "find", '{"text": 5}', []), (1, 3, "c", "find", '{"limit": 1.5, "x": 1}', []),
        (1, 4, "d", "other", "{}", []), (1, 5, "e", "find", "[1]", []), (1, 6, "f", "find", "{broken", []), (1, 7, "g", None, None, None),
        (1, 8, "h", "find", '{"text": "t"}', ["nowhere"]), (1, 9, "i", "find", '{"text": "t"}', []),
        (1, 9, "i", "find", '{"text": "t"}', []), (1, 12, "i", "find", '{"text": "later"}', []),
        (None, 1, "a", "find", ok, []), (1, 1, None, "find", ok, []),
    ]
    results = [(1, 9, "a", "second"), (1, 8, "a", "first"), (1, 8, "a", "first"), (1, 9, "h", None), (1, 1, "z", "of no call"), (2, 1, "i", "elsewhere")]
    got, n = link(spark, calls, results)
    assert n == len(got) == 9
    status = {k[1]: (r["status"], r["faults"]) for k, r in got.items()}
    assert status == {
        "a": ("ok", ""), "b": ("invalid", "type of text"), "c": ("invalid", "missing text,type of limit,unknown x"),
        "d": ("invalid", "unknown tool"), "e": ("invalid", "arguments are no object"), "f": ("invalid", "arguments are no object"),
        "g": ("invalid", "unknown tool"), "h": ("unmet", ""), "i": ("no result", ""),
    }
    a = got[1, "a"]
    want = {"after": [], "arguments": json.loads(ok), "id": "a", "name": "find", "result": "first"}
    assert a["message"] == json.dumps(want, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    assert a["n_results"] == 2 and got[1, "h"]["n_results"] == 1 and got[1, "i"]["turn"] == 9


def test_order(spark):
    needs = {"a": [], "b": ["a"], "c": ["b"], "d": ["a", "c"], "e": ["d", "b", "b"], "f": ["e"], "x": ["y"], "y": ["x"], "z": ["x"], "w": ["z", "a"], "s": ["s"]}
    calls = [(1, 100 - i, k, "find", '{"text": "t"}', v) for i, (k, v) in enumerate(needs.items())]
    calls += [(2, i, f"n{i}", "find", '{"text": "t"}', [f"n{i - 1}"] if i else []) for i in range(3000)]
    got, _ = link(spark, calls, [])
    levels = {k: got[1, k]["level"] for k in needs}
    assert levels == {"a": 0, "b": 1, "c": 2, "d": 3, "e": 4, "f": 5, "x": None, "y": None, "z": None, "w": None, "s": None}
    assert [got[1, k]["position"] for k in "abcdef"] == [1, 2, 3, 4, 5, 6]
    assert {got[1, k]["status"] for k in "xyzws"} == {"cycle"} and got[1, "x"]["position"] is None
    assert all((got[2, f"n{i}"]["level"], got[2, f"n{i}"]["position"]) == (i, i + 1) for i in range(3000))


def test_messages_and_turns(spark):
    turns = [
        (1, 0, "system", "s"), (1, 1, "user", "q1"), (1, 2, "assistant", "a1"), (1, 3, "user", "q2"),
        (1, 4, "assistant", '{"tool_calls": [{"id": "t1", "name": "find", "arguments": {"text": "x"}}, {"id": "t2", "name": "find", "arguments": {}, "after": ["t1"]}]}'),
        (1, 5, "tool", '{"tool_call_id": "t1", "content": "found"}'), (1, 6, "assistant", "{not json"), (2, 0, "user", None), (2, None, "user", "q"), (None, 0, "user", "q"),
    ]
    turns = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS call_id", "2 AS name")
    calls, results = (a.unionByName(b) for a, b in zip(tc.tool_messages(turns), tc.turn_pairs(turns)))
    tools = tc.schemas_table(spark, [*TOOLS, ("reply", "request", "string", True)])
    got = {r["call_id"]: r for r in tc.link(calls, results, tools).collect()}
    assert {k: (r["status"], r["level"], r["faults"]) for k, r in got.items()} == {
        "1:1": ("ok", 0, ""), "1:3": ("no result", 1, ""), "t1": ("ok", 0, ""), "t2": ("invalid", 1, "missing text"), "2:0": ("invalid", 0, "missing request"),
    }
    assert got["t1"]["message"] == '{"after":[],"arguments":{"text":"x"},"id":"t1","name":"find","result":"found"}'


def test_turns_that_start_with_a_brace(spark, tmp_path):
    """Pasted JSON and code are turns as others: the query and its SQL agree."""
    turns = [
        (1, 1, "user", "q"), (1, 2, "assistant", '{"answer": 1}'), (1, 3, "user", '{"pasted": [1, 2]}'), (1, 4, "assistant", "{% if x %}"),
        (1, 5, "user", "{template}"), (1, 6, "assistant", '{"tool_calls": null}'), (1, 7, "user", '{"tool_calls": [{"id": "u", "name": "reply"}]}'),
        (1, 8, "assistant", '{"tool_calls": []}'), (1, 9, "user", '{"tool_call_id": "t"}'), (1, 10, "assistant", '{"tool_calls": [{"name": "no id"}]}'),
        (1, 11, "user", "last"), (2, 1, "user", "{"), (2, 2, "assistant", '{"tool_call_id": "t", "content": "c"}'),
    ]
    # The tables' own types, so that the SQL compares alike.
    shape = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").schema
    kind = {f.name: f.dataType.simpleString() for f in shape}
    rows = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    rows = rows.selectExpr(*(f"CAST({c} AS {kind[c]}) AS {c}" for c in rows.columns))
    rows.toPandas().to_parquet(tmp_path / "conversations.parquet")
    got = queries.op10_tool_calls(spark, str(tmp_path))
    assert got.count() == 7
    assert differences(got, connect(str(tmp_path)), queries.OP10_SQL) == []


@pytest.mark.parametrize("calls", [[], [(1, 1, "a", "find", "{}", [])]])
def test_empty(spark, calls):
    assert link(spark, calls, [])[1] == len(calls)


def test_native(spark):
    """No Python, pandas or Arrow step in the plan; joins by identifier are hash joins."""
    turns = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    calls, results = tc.turn_pairs(turns)
    for made in (tc.link(calls, results, tc.schemas_table(spark, TOOLS)), queries.op10_tool_calls(spark, "/root/testdata/sf0.001")):
        plan = made._jdf.queryExecution().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
        assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan


def test_positions_over_blocks_of_levels(spark, monkeypatch):
    """A chain that spans blocks, and blocks of blocks, of levels, beside calls that need none."""
    monkeypatch.setattr(tc, "BUCKET", 3)
    calls = [(1, 2 * i, f"n{i:03}", "find", '{"text": "t"}', [f"n{i - 1:03}"] if i else []) for i in range(50)]
    calls += [(1, 1000 - i, f"f{i}", "find", '{"text": "t"}', []) for i in range(20)]
    calls += [(1, 2000 + i, f"g{i}", "find", '{"text": "t"}', ["n010"]) for i in range(7)]
    got, _ = link(spark, calls, [])
    order = sorted(got.values(), key=lambda r: (r["level"], r["turn"], r["call_id"]))
    assert [r["position"] for r in order] == list(range(1, len(calls) + 1))
