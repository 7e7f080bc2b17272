"""Answers in rounds: all open questions take their turn together, with one batched model call and one join for each tool.

A question's messages are one row. In a round the model says something for every open question; those that ask for tools wait for what the tools
find and go on to the next round, the others leave. A tool is a function of a table of calls, so a thousand questions that search are
one search. There are at most ``max_iterations`` rounds; calls that are still wanted in the last one are not made. Each round is staged,
so a model is asked once, and a lost executor costs no more than the round at work.

Defined results: question ids are unique; a null question is empty; a model that keeps failing for a question ends it, with its error and
the messages so far; a call of a tool that is not there, or that a tool does not answer, is answered by an error text; no
questions give no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from docloom.operators import agents
from docloom.operators.points import retrying
from docloom.session import Staged

# What an agent is told first.
SYSTEM = "You are a technical expert. Use tools to gather info and answer accurately."
ASK = ("Question: ", "\n\nAnswer using available tools.")

CALLS = "array<struct<name:string,args:string>>"
MESSAGE = f"struct<role:string,content:string,calls:{CALLS}>"
_OPEN = f"question_id string, messages array<{MESSAGE}>"
_SAID = f"{_OPEN}, content string, calls {CALLS}, error string"

#: Messages of each question, as dicts, to what is said next: {content, calls: [{name, args}]}, in the same order.
Model = Callable[[list[list[dict]]], list[dict]]
#: (question_id, k, args) to (question_id, k, result): at most a row for each call.
Tool = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Rounds:
    """How questions are answered: the model that takes turns, the tools it may call, and the one that makes an answer of the trace
    ({context, question} to {answer, cited})."""

    model: Model
    tools: Mapping[str, Tool]
    synthesise: Callable[[dict], dict]
    max_iterations: int = 10
    batch: int = 32
    tries: int = 3
    wait: float = 1.0


def _message(role: str, content: Column, calls: Column | None = None) -> Column:
    none = F.array().cast(CALLS)
    return F.struct(F.lit(role).alias("role"), F.coalesce(content, F.lit("")).alias("content"), (none if calls is None else F.coalesce(calls, none)).alias("calls"))


def _ask(waiting: DataFrame, how: Rounds) -> DataFrame:
    """Rows of ``_SAID``: what the model says to each open question. If a call for a batch fails, its questions are asked one by one."""
    arrow = to_arrow_schema(StructType.fromDDL(_SAID))
    model, size, tries, wait = how.model, how.batch, how.tries, how.wait  # what tasks need; tools stay here

    def one(messages: list[dict]) -> dict:
        try:
            said = retrying(model, [messages], tries=tries, base=wait)[0]
            return {"content": said.get("content") or "", "calls": said.get("calls") or [], "error": None}
        except Exception as e:  # noqa: BLE001 - a model's fault is that question's
            return {"content": None, "calls": None, "error": f"{type(e).__name__}: {e}"}

    def many(messages: list[list[dict]]) -> list[dict]:
        try:
            said = model(messages)
            if len(said) == len(messages):
                return [{"content": s.get("content") or "", "calls": s.get("calls") or [], "error": None} for s in said]
        except Exception:  # noqa: BLE001 - which question it was shows when they are asked alone
            pass
        return [one(m) for m in messages]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, size):
                part = whole.slice(start, size)
                said = many(part.column("messages").to_pylist())
                made = [pa.array([s[f.name] for s in said], f.type) for f in arrow if f.name in ("content", "calls", "error")]
                yield pa.RecordBatch.from_arrays([part.column("question_id").cast(arrow.field(0).type), part.column("messages").cast(arrow.field(1).type), *made], schema=arrow)

    return waiting.mapInArrow(run, _SAID)


def _results(calls: DataFrame, tools: Mapping[str, Tool]) -> DataFrame:
    """(question_id, told): the answers to a question's calls as messages, in the order of the calls."""
    found = None
    for name, tool in tools.items():
        part = tool(calls.where(F.col("name") == name).select("question_id", "k", "args")).select("question_id", "k", "result")
        found = part if found is None else found.unionByName(part)
    missing = F.concat(F.lit("Error: no result of tool "), F.coalesce("name", F.lit("")))
    answered = calls.withColumn("result", F.lit(None).cast("string")) if found is None else calls.join(found, ["question_id", "k"], "left")
    listed = answered.groupBy("question_id").agg(F.array_sort(F.collect_list(F.struct("k", F.coalesce("result", missing).alias("result")))).alias("r"))
    return listed.select("question_id", F.transform("r", lambda x: _message("tool", x["result"])).alias("told"))


def traces(questions: DataFrame, how: Rounds) -> DataFrame:
    """question_id, iterations, messages array<struct<role, content, calls>>, error of every question (question_id, question)."""
    first = F.array(_message("system", F.lit(SYSTEM)), _message("human", F.concat(F.lit(ASK[0]), F.coalesce("question", F.lit("")), F.lit(ASK[1]))))
    waiting = Staged(questions.select(F.col("question_id").cast("string").alias("question_id"), first.cast(f"array<{MESSAGE}>").alias("messages")), "open").df
    done = None
    for turn in range(1, how.max_iterations + 1):
        said = Staged(_ask(waiting, how), "said").df
        reply = F.concat("messages", F.array(_message("ai", F.col("content"), F.col("calls"))))
        ends = F.col("error").isNotNull() | (F.size("calls") == 0) | F.lit(turn == how.max_iterations)
        left = said.where(ends).select("question_id", F.lit(turn).alias("iterations"), F.when(F.col("error").isNull(), reply).otherwise(F.col("messages")).alias("messages"), "error")
        done = left if done is None else done.unionByName(left)
        going = said.where(~ends)
        if turn == how.max_iterations or going.isEmpty():
            break
        calls = Staged(going.select("question_id", F.posexplode("calls").alias("k", "call")).select("question_id", "k", "call.name", "call.args"), "calls").df
        told = _results(calls, how.tools)
        waiting = Staged(going.join(told, "question_id").select("question_id", F.concat(reply, "told").alias("messages")), "open").df
    return done


def answers(questions: DataFrame, how: Rounds) -> DataFrame:
    """question_id, answer, trace (the steps as tagged text), sources, iterations, error: traces, and what ``synthesise`` makes of them and cites."""
    held = Staged(traces(questions, how), "traces").df
    rows = held.where("error is null").select("question_id", F.posexplode("messages").alias("turn", "m")).select("question_id", "turn", "m.*")
    steps = agents.format_reasoning(agents.reasoning_steps(rows, "question_id", "turn"), "question_id").withColumnRenamed("reasoning", "trace")
    found = agents.message_sources(rows.where("role = 'tool'"), "question_id").groupBy("question_id").agg(F.collect_set("source").alias("found"))
    context = agents.synthesis_context(rows, "question_id", "turn")
    asked = questions.select(F.col("question_id").cast("string").alias("question_id"), "question")
    made = agents.model_columns(context.join(asked, "question_id"), "answer string, cited array<string>", how.synthesise, ["context", "question"]).select("question_id", "answer", "cited", F.col("error").alias("late"))
    none = F.array().cast("array<string>")
    every = held.select("question_id", "iterations", "error")
    for more in (made, steps, found):
        every = every.join(more, "question_id", "left")
    sources = F.array_sort(F.array_union(F.coalesce("found", none), F.coalesce("cited", none)))
    return every.select("question_id", "answer", F.coalesce("trace", F.lit("")).alias("trace"), sources.alias("sources"), "iterations", F.coalesce("error", "late").alias("error"))
