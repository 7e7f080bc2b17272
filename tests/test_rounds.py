"""Answers in rounds against a plain loop over each question, with failing calls, calls side by side and the limit."""

import json

from pyspark.sql import functions as F

from docloom.config import DatasetConfig
from docloom.operators import agents, vector_index
from docloom.operators.agent_tools import link_tool, search_tool
from docloom.plans import dataset
from docloom.plans.rounds import ASK, SYSTEM, Rounds, answers, traces

TEXTS = {f"c{k}": f"text {k} " + "word " * k for k in range(8)}
LINKS = {f"c{k}": (f"c{k + 1}" if k < 7 else "gone", f"c{k - 1}" if k else None) for k in range(8)}


def model(asked):
    """Questions name a plan: letters say what to do in each turn."""
    out = []
    for messages in asked:
        plan, start = messages[1]["content"].removeprefix(ASK[0]).split("\n")[0].split(":")
        turn = sum(m["role"] == "ai" for m in messages)
        step = plan[turn] if turn < len(plan) else "."
        if step == "!":
            raise OSError("down")
        last = next((m["content"] for m in reversed(messages) if m["role"] == "tool" and m["content"].startswith("[")), None)
        at = json.loads(last)[0]["chunk_id"] if last else start
        call = {"n": [("link", {"chunk_id": at, "direction": "next"})], "b": [("link", {"chunk_id": at, "direction": "prev"}), ("link", {"chunk_id": at})], "?": [("nothing", {})], "x": [("link", {})], ".": []}[step]
        out.append({"content": f"turn {turn}" if step != "n" else "", "calls": [{"name": n, "args": json.dumps(a)} for n, a in call]})
    return out


def plain_tool(name, args):
    if name != "link":
        return f"Error: no result of tool {name}"
    side = args.get("direction") or "next"
    to = LINKS.get(args.get("chunk_id"), (None, None))[side == "prev"]
    if to is None:
        return f"Error: no {side} link"
    return "[" + json.dumps({"chunk_id": to, "content": TEXTS[to][:500]}, separators=(",", ":")) + "]" if to in TEXTS else "Error: linked chunk not found"


def plain_trace(question, limit):
    messages = [{"role": "system", "content": SYSTEM, "calls": []}, {"role": "human", "content": f"{ASK[0]}{question}{ASK[1]}", "calls": []}]
    for turn in range(1, limit + 1):
        try:
            said = model([messages])[0]
        except OSError as e:
            return turn, messages, f"OSError: {e}"
        messages = [*messages, {"role": "ai", **said}]
        if not said["calls"] or turn == limit:
            return turn, messages, None
        messages = [*messages, *({"role": "tool", "content": plain_tool(c["name"], json.loads(c["args"])), "calls": []} for c in said["calls"])]
    raise AssertionError


QUESTIONS = {"q0": ".:c0", "q1": "nn:c0", "q2": "nnnnnnnnn:c1", "q3": "b.:c0", "q4": "n!:c3", "q5": "?n:c4", "q6": "xn:c7", "q7": "!:c0", "q8": "nbn:c6", "q9": "bbbb:c5"}


def how(spark, limit=4):
    chunks = spark.createDataFrame(list(TEXTS.items()), "id string, content string")
    links = spark.createDataFrame([(k, *v) for k, v in LINKS.items()], "id string, next_id string, prev_id string")
    return Rounds(model, {"link": link_tool(links, chunks)}, lambda row: {"answer": f"{len(row['context'])} of {row['question']}", "cited": ["own"]}, limit, batch=3, wait=0.0)


def test_traces_equal_a_plain_loop(spark):
    asked = spark.createDataFrame([(*q, 1) for q in QUESTIONS.items()], "question_id string, question string, messages int")
    for limit in (1, 4):
        got = {r.question_id: (r.iterations, [m.asDict(True) for m in r.messages], r.error) for r in traces(asked, how(spark, limit)).collect()}
        assert got == {q: plain_trace(text, limit) for q, text in QUESTIONS.items()}
    assert traces(asked.limit(0), how(spark)).count() == 0


def test_answers_and_dataset(spark):
    asked = spark.createDataFrame(list(QUESTIONS.items()), "question_id string, question string")
    got = {r.question_id: r for r in answers(asked, how(spark)).collect()}
    assert set(got) == set(QUESTIONS) and {q for q, r in got.items() if r.error} == {"q4", "q7"}
    assert got["q1"].sources == ["c1", "c2", "own"] and got["q1"].iterations == 3 and got["q1"].answer.endswith("of nn:c0")
    assert got["q1"].trace.count("<|step|>") == 2 and agents.DEFAULT_THOUGHT in got["q1"].trace and got["q0"].trace == ""
    assert got["q7"].answer is None and got["q7"].trace == ""
    chunks = spark.createDataFrame([("c1", "nn:c0"), ("c2", "!:c0")], "chunk_id string, content string")
    ask = lambda content, easy, medium: [{"question": content, "question_type": "easy", "rationale": "r"}]
    judge = lambda row: dict.fromkeys(agents.SCORES, 1.0)
    made = dataset.build_all(chunks, DatasetConfig(), ask, lambda content, qs: [1], how(spark), judge, "now")
    entry = made.entries.collect()
    assert [(e.question, e.source_chunks, e.metadata.iterations) for e in entry] == [("nn:c0", ["c1", "c2", "own"], 3)]
    assert [(r.question_id, r.step, r.error) for r in made.failures.collect()] == [("c2_q1", "answer", "OSError: down")]
    assert made.counts == {"questions": 2, "answered": 1, "failed": 1, "accepted": 1}


def test_search_tool(spark):
    embed = lambda texts: [[float(len(t)), 10.0] for t in texts]
    chunks = spark.createDataFrame([(k, "x" * (3 * k + 1)) for k in range(12)], "vec_id long, content string")
    vectors = chunks.select("vec_id", F.array(F.length("content").cast("float"), F.lit(10.0).cast("float")).alias("embedding"))
    tool = search_tool(vector_index.build(vectors, lists=1), chunks, embed, 2)
    calls = spark.createDataFrame([("q", 0, json.dumps({"query": "y" * 10})), ("q", 1, "{}"), ("r", 0, None), ("s", 0, json.dumps({"query": ""}))], "question_id string, k int, args string")
    got = {(r.question_id, r.k): r.result for r in tool(calls).collect()}
    assert json.loads(got["q", 0])[0]["chunk_id"] == "3" and len(json.loads(got["q", 0])) == 2
    assert got["q", 1] == got["r", 0] == "Error: no query" and json.loads(got["s", 0])[0]["chunk_id"] == "0"
