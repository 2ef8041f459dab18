import json
import random

from cohortlens.llm.tool_chat import format_chats

KIND = "conv_id long, turn long, role string, text string, call_id string, tool string, status string"


def chat(spark, rows):
    return [r.asDict() for r in format_chats(spark.createDataFrame([(*r, "x", "x", "x") for r in rows], KIND)).collect()]


def test_linking_order_and_checks(spark):
    say = json.dumps
    rows = [
        (1, 0, "user", 'hi "x"\n'), (1, 0, "tool", say({"tool_call_id": "a", "content": "early"})),
        (1, 1, "assistant", say({"content": "look", "tool_calls": [
            {"id": "a", "name": "search", "arguments": {"query": "z", "limit": 3}},
            {"id": "b", "function": {"name": "weather", "arguments": '{"place": 5, "when": 1}'}},
            {"id": "c", "name": "nope", "arguments": {}}]})),
        (1, 3, "tool", say({"tool_call_id": "zz", "content": "?"})),
        (1, 4, "assistant", say({"tool_calls": [{"id": "a", "name": "search", "arguments": "not json"},
                                                {"id": "d", "name": "search", "arguments": {}}]})),
        (2, 0, "tool", say({"tool_call_id": "a", "content": "elsewhere"})), (None, 0, None, None), (None, 1, "tool", '{"tool_call_id": "q"'),
    ]
    got = chat(spark, rows)
    state = {(r["conv_id"], r["turn"], r["kind"], r["call_id"]): (r["status"], r["faults"]) for r in got if r["kind"] != "message"}
    assert state == {
        (1, 1, "call", "a"): ("answered", ""), (1, 1, "call", "b"): ("unanswered", "place,when"),
        (1, 1, "call", "c"): ("unanswered", "unknown tool"), (1, 4, "call", "a"): ("repeated", "unreadable arguments"),
        (1, 4, "call", "d"): ("unanswered", "query"), (1, 0, "result", "a"): ("linked", ""), (1, 3, "result", "zz"): ("orphan", ""),
        (2, 0, "result", "a"): ("orphan", "")}
    order = lambda r: (r["at_turn"], r["step"], r["place"])
    call = next(r for r in got if r["kind"] == "call" and r["call_id"] == "a" and r["turn"] == 1)
    result = next(r for r in got if r["kind"] == "result" and r["call_id"] == "a" and r["conv_id"] == 1)
    assert order(call) < order(result)
    assert call["line"] == '{"arguments":{"limit":3,"query":"z"},"call_id":"a","role":"assistant","tool":"search","turn":1}'
    for r in got:
        assert list(json.loads(r["line"])) == sorted(json.loads(r["line"]))
    plain = {(r["conv_id"], r["turn"]): json.loads(r["line"])["content"] for r in got if r["kind"] == "message"}
    assert plain[1, 0] == 'hi "x"\n' and plain[1, 1] == "look" and plain[None, 0] == "" and plain[None, 1].startswith("{")


def test_brute_force_over_one_long_conversation(spark):
    random.seed(2)
    rows = [(7, 0, "user", "long " * 50_000), (7, 0, "user", "twice"), (7, 0, "user", "twice")]
    calls, results = {}, []
    for turn in range(1, 120):
        name = f"id{random.randint(0, 40)}"
        if random.random() < 0.5:
            calls.setdefault(name, []).append(turn)
            rows.append((7, turn, "assistant", json.dumps({"tool_calls": [{"id": name, "name": "lookup", "arguments": {"key": "k"}}]})))
        else:
            results.append((name, turn))
            rows.append((7, turn, "tool", json.dumps({"tool_call_id": name, "content": str(turn)})))
    got = chat(spark, rows)
    want = {(n, t): ("linked", max(t, min(calls[n]))) if n in calls else ("orphan", t) for n, t in results}
    assert {(r["call_id"], r["turn"]): (r["status"], r["at_turn"]) for r in got if r["kind"] == "result"} == want
    answered = {n for n, _ in results}
    assert {(r["call_id"], r["turn"]): r["status"] for r in got if r["kind"] == "call"} == {
        (n, t): "repeated" if t != min(ts) else "answered" if n in answered else "unanswered" for n, ts in calls.items() for t in ts}
    assert sum(r["kind"] == "message" for r in got) == 3 + sum(map(len, calls.values()))


def test_empty_table_and_no_python(spark):
    assert chat(spark, []) == []
    plan = format_chats(spark.createDataFrame([(1, 0, "user", "x")], "conv_id long, turn long, role string, text string"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert not any(x in text for x in ("Python", "Pandas", "Arrow"))


def test_no_text_is_lost(spark):
    broken = ['{the "tool_calls" field is explained here}', '{"tool_call_id": "a", "content": }', '{"tool_calls": 5, "content": "c"}',
              '{"tool_calls": [1, "x"], "content": "c"}', '{"tool_calls": "none", "tool_call_id": "q"}', '{"x": {"tool_call_id": "a"}}',
              '{"tool_calls": null, "content": "c"}', '{"tool_calls": [{"id": "a"}, null]}']
    got = chat(spark, [(1, i, "user", t) for i, t in enumerate(broken)])
    assert {r["turn"]: (r["kind"], json.loads(r["line"])["content"]) for r in got} == {
        i: ("message", t) for i, t in enumerate(broken)} and len(got) == len(broken)


def test_further_fields_stay_in_the_line(spark):
    rows = [(1, 0, "assistant", '\n{"tool_calls": [{"id": "a", "name": "lookup", "arguments": {"key": "k"}}], "b": [1, null], "a": {"z": 1}} '),
            (1, 1, "tool", '{"tool_call_id": "a", "content": "c", "name": "lookup", "tool_calls": null}'), (1, 2, "user", "plain")]
    got = {(r["kind"], r["turn"]): r["line"] for r in chat(spark, rows)}
    assert got["message", 0] == '{"content":"","more":{"a":{"z":1},"b":[1,null]},"role":"assistant","turn":0}'
    assert got["result", 1] == '{"call_id":"a","content":"c","more":{"name":"lookup"},"role":"tool","turn":1}'
    assert got["message", 2] == '{"content":"plain","role":"user","turn":2}' and ("call", 0) in got and len(got) == 4


def test_fields_of_calls_and_typed_content_stay(spark):
    calls = [{"id": "a", "type": "function", "extra": {"k": [1, None]}, "function": {"name": "lookup", "arguments": {"key": "k"}, "strict": True}},
             {"id": "b", "name": "lookup", "arguments": {"key": "k"}, "function": {"name": "other", "arguments": "{}"}},
             {"id": "c", "name": "lookup", "arguments": {"key": "k"}, "function": "text"}, {"id": "d", "name": "lookup"}]
    rows = [(1, 0, "assistant", json.dumps({"tool_calls": calls, "content": [{"type": "text", "text": "t"}]})),
            (1, 1, "tool", '{"tool_call_id": "a", "content": {"k": 1}}'), (1, 2, "tool", '{"tool_call_id": "b", "content": 5}'),
            (1, 3, "tool", '{"tool_call_id": "c", "content": "5"}'), (1, 4, "tool", '{"tool_call_id": "d", "content": null}')]
    got = {(r["kind"], r["call_id"]): json.loads(r["line"]) for r in chat(spark, rows)}
    assert got["message", None]["content"] == [{"type": "text", "text": "t"}]
    assert [got["result", x]["content"] for x in "abcd"] == [{"k": 1}, 5, "5", ""]
    assert got["call", "a"]["more"] == {"type": "function", "extra": {"k": [1, None]}, "function": {"strict": True}}
    assert got["call", "b"]["more"] == {"function": {"name": "other", "arguments": "{}"}}
    assert got["call", "c"]["more"] == {"function": "text"} and "more" not in got["call", "d"]
    assert got["call", "a"]["tool"] == "lookup" and got["call", "a"]["arguments"] == {"key": "k"}


def test_repeated_rows_of_one_call(spark):
    call = json.dumps({"tool_calls": [{"id": "a", "name": "lookup", "arguments": {"key": "k"}}]})
    rows = [(1, 0, "assistant", call), (1, 0, "assistant", call), (1, 1, "tool", '{"tool_call_id": "a", "content": "c"}')]
    got = chat(spark, rows)
    assert [r["status"] for r in got if r["kind"] == "call"] == ["answered", "answered"]
    assert [r["status"] for r in got if r["kind"] == "result"] == ["linked"] and len(got) == 5
