"""What agents make of chunks and messages: question, answer and definition columns of pluggable models, and the
relational steps between them.

Messages are rows (conversation, turn, role, content, calls) with role one of system, human, ai and tool and
calls array<struct<name, args>>. A conversation is the trace of one answer, and its steps are few.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from docloom.functions.json_text import loose_json
from docloom.functions.text import ellipsis
from docloom.operators.points import retrying

# Words that ask for a side, texts of prompts, fields of a function's documentation, scores of an answer.
PREVIOUS_WORDS = ("previous", "before", "context")
NEXT_WORDS = ("next", "following", "after")
DEFAULT_THOUGHT = "Using tool to gather information..."
SYNTHESIS_HEAD, SYNTHESIS_STEPS = "ORIGINAL QUESTION: ", "\nREASONING PROCESS FOLLOWED:"
SYNTHESIS_END = "\nBASED ON THE ABOVE REASONING, PROVIDE A COMPREHENSIVE FINAL ANSWER:"
FIELDS = ("cautions", "references", "code_examples")
SCORES = ("completeness", "accuracy", "relevance", "clarity", "specificity", "reasoning")


def adjacency_need(question: Column, points: Column) -> Column:
    """struct<previous, next>: whether a question about a chunk needs its neighbours, as a point has a link to that side
    or the question, in any case, holds one of the side's words."""

    def need(side: str, words: Sequence[str]) -> Column:
        linked = F.exists(points, lambda p: p[side].isNotNull())
        return F.coalesce(linked, F.lit(False)) | F.coalesce(F.lower(question).rlike("|".join(words)), F.lit(False))

    return F.struct(need("prev_link", PREVIOUS_WORDS).alias("previous"), need("next_link", NEXT_WORDS).alias("next"))


def answer_context(question: Column, chunk_id: Column, content: Column, need: Column, previous: Column, following: Column) -> Column:
    """The text an answer starts from; ``previous`` and ``following`` are struct<id, content>, null where there is none."""

    def side(title: str, wanted: Column, other: Column) -> Column:
        told = F.concat(F.lit(f"{title} Chunk Context (ID: "), other["id"].cast("string"), F.lit("):\n"), F.substring(other["content"], 1, 1000), F.lit("\n\n"))
        return F.when(wanted & other["id"].isNotNull(), told).otherwise("")

    own = F.concat(F.lit("Question: "), question, F.lit("\n\nCurrent Chunk (ID: "), chunk_id.cast("string"), F.lit("):\n"), F.substring(content, 1, 1500), F.lit("\n\n"))
    return F.concat(own, side("Previous", need["previous"], previous), side("Next", need["next"], following))


def reasoning_steps(messages: DataFrame, conversation: str, turn: str) -> DataFrame:
    """conversation, step_number, thought, action, action_input, observation: one step a tool call, numbered through the
    conversation. All calls of a message observe the message after it if that is a tool's, cut to 500 characters."""
    order = Window.partitionBy(conversation).orderBy(turn)
    after = F.when(F.lead("role").over(order) == "tool", F.lead("content").over(order))
    seen = messages.withColumn("observation", ellipsis(F.coalesce(after, F.lit("")), 500)).where("role = 'ai' and size(calls) > 0")
    thought = F.coalesce(F.nullif("content", F.lit("")), F.lit(DEFAULT_THOUGHT)).alias("thought")
    calls = seen.select(conversation, turn, thought, "observation", F.posexplode("calls").alias("k", "call"))
    number = F.row_number().over(Window.partitionBy(conversation).orderBy(turn, "k")).cast("long")
    return calls.select(conversation, number.alias("step_number"), "thought", F.coalesce("call.name", F.lit("unknown_tool")).alias("action"), F.coalesce("call.args", F.lit("{}")).alias("action_input"), "observation")


def format_reasoning(steps: DataFrame, conversation: str) -> DataFrame:
    """conversation, reasoning: the steps as tagged text in their order."""
    tagged = lambda tag, c: F.concat(F.lit(f"<|{tag}|>"), c, F.lit(f"<|end_{tag}|>\n"))
    shown = F.concat(tagged("step", F.col("step_number").cast("string")), tagged("thought", F.col("thought")), tagged("action", F.col("action")), tagged("observation", F.col("observation")))
    listed = steps.groupBy(conversation).agg(F.array_sort(F.collect_list(F.struct("step_number", shown.alias("shown")))).alias("s"))
    return listed.select(conversation, F.array_join(F.transform("s", lambda x: x["shown"]), "").alias("reasoning"))


def synthesis_context(messages: DataFrame, conversation: str, turn: str) -> DataFrame:
    """conversation, context: the question (the first human message) and the trace under new names of the roles, without
    system messages; tool results are cut to 1,000 characters."""
    used = F.transform("calls", lambda c: F.concat(F.lit("USED TOOL: "), c["name"], F.lit("("), c["args"], F.lit(")")))
    said = F.when(F.col("content") != "", F.array(F.concat(F.lit("A: "), F.col("content")))).otherwise(F.array().cast("array<string>"))
    shown = F.when(F.col("role") == "human", F.array(F.concat(F.lit("Q: "), F.col("content")))).when(F.col("role") == "tool", F.array(F.concat(F.lit("TOOL RESULT: "), ellipsis(F.col("content"), 1000))))
    shown = shown.otherwise(F.concat(said, F.coalesce(used, F.array().cast("array<string>"))))
    rows = messages.where("role <> 'system'").select(conversation, "role", "content", turn, F.struct(turn, shown.alias("shown")).alias("m"))
    asked = F.min_by(F.when(F.col("role") == "human", F.col("content")), F.when(F.col("role") == "human", F.col(turn)))
    listed = rows.groupBy(conversation).agg(F.coalesce(asked, F.lit("")).alias("asked"), F.array_sort(F.collect_list("m")).alias("m"))
    body = F.flatten(F.transform("m", lambda m: m["shown"]))
    return listed.select(conversation, F.array_join(F.concat(F.array(F.concat(F.lit(SYNTHESIS_HEAD), "asked"), F.lit(SYNTHESIS_STEPS)), body, F.array(F.lit(SYNTHESIS_END))), "\n").alias("context"))


def message_sources(messages: DataFrame, conversation: str, content: str = "content") -> DataFrame:
    """conversation, source: the distinct chunk_id, or else entity_id, of the objects in messages that hold a JSON list."""
    items = F.explode(F.try_variant_get(loose_json(F.col(content)), "$", "array<variant>")).alias("item")
    objects = messages.select(conversation, items).where(F.startswith(F.schema_of_variant("item"), F.lit("OBJECT")))
    named = F.coalesce(F.try_variant_get("item", "$.chunk_id", "string"), F.try_variant_get("item", "$.entity_id", "string"))
    return objects.select(conversation, named.alias("source")).where("source is not null").distinct()


def fold_updates(log: DataFrame, doc: str, order: str) -> DataFrame:
    """doc, field, entries after a log of updates (doc, order, field, value array<string>, append): a value is appended, or
    replaces all before it. Fields that a documentation doesn't have are left out. A field's updates are few."""
    known = log.where(F.col("field").isin(*FIELDS))
    listed = known.groupBy(doc, "field").agg(F.array_sort(F.collect_list(F.struct(order, "append", "value"))).alias("updates"))
    folded = F.aggregate("updates", F.array().cast("array<string>"), lambda held, u: F.when(u["append"], F.concat(held, u["value"])).otherwise(u["value"]))
    return listed.select(doc, "field", folded.alias("entries"))


def recent_context(visited: Column) -> Column:
    """The text that shows an agent the last two chunks it saw, array<struct<id, summary, content>>; none if it saw none."""

    def shown(c: Column) -> Column:
        summary = F.array_join(F.transform(F.slice(c["summary"], 1, 2), lambda s: F.concat(F.lit("'"), s, F.lit("'"))), ", ")
        return F.concat(F.lit("\nChunk "), c["id"].cast("string"), F.lit(":\nSummary: ["), summary, F.lit("]\nContent preview: "), F.substring(c["content"], 1, 300), F.lit("...\n"))

    last = F.slice(visited, F.greatest(F.lit(1), F.size(visited) - 1), F.lit(2))
    return F.when(F.size(visited) > 0, F.concat(F.lit("\n\nRECENTLY VIEWED CHUNKS:\n"), F.array_join(F.transform(last, shown), "")))


def guided_walk(start: Column, moves: Column, ahead: Column, back: Column, max_next: int = 5, max_prev: int = 2, max_iterations: int = 15) -> Column:
    """The ids in the order they are reached, the start first: of ``moves`` ('next' or 'prev') the first ``max_iterations`` are taken; a move past its
    direction's limit, or past the end of its chain, does nothing, and where both limits are reached the walk is over. ``ahead`` and ``back``
    are the ids on the chains, the nearest first. An expression on the row: a chain has at most its limit of entries."""
    taken = F.slice(moves, 1, max_iterations)
    nth = lambda direction: F.transform(taken, lambda m, i: F.when(m == direction, F.size(F.filter(F.slice(taken, F.lit(1), i + 1), lambda x: x == direction))))
    reached = lambda n, chain, most: F.when((n <= most) & (n <= F.size(chain)), F.get(chain, n - 1))
    visited = F.zip_with(nth("next"), nth("prev"), lambda n, p: F.coalesce(reached(n, ahead, max_next), reached(p, back, max_prev)))
    return F.concat(F.array(start), F.array_compact(visited))


def easy_count(n: int, ratio: float) -> int:
    """How many of ``n`` questions are easy; the others are of medium difficulty."""
    return int(n * ratio)


def model_columns(df: DataFrame, schema: str, one: Callable[[dict], dict | None], columns: Sequence[str], batch: int = 64) -> DataFrame:
    """``df`` with the columns of ``schema`` as ``one`` makes them of each row's ``columns``; a call that keeps failing gives
    nulls and its ``error``."""
    added = StructType.fromDDL(f"{schema}, error string")
    arrow = to_arrow_schema(StructType([*df.schema.fields, *added.fields]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, batch):
                part = whole.slice(start, batch)
                made: list[dict] = []
                for row in part.select(list(columns)).to_pylist():
                    try:
                        made.append({**(retrying(one, row, base=0.0) or {}), "error": None})
                    except Exception as e:  # noqa: BLE001 - a model's fault is that row's
                        made.append({"error": f"{type(e).__name__}: {e}"})
                new = [pa.array([m.get(f.name) for m in made], arrow.field(f.name).type) for f in added]
                yield pa.RecordBatch.from_arrays([*(part.column(k).cast(arrow.field(k).type) for k in range(part.num_columns)), *new], schema=arrow)

    return df.mapInArrow(run, StructType([*df.schema.fields, *added.fields]))


def generate_questions(df: DataFrame, ask: Callable[[str, int, int], list[dict]], keep: Callable[[str, list[str]], list[int]], n: int = 10, easy_ratio: float = 0.3, id_col: str = "chunk_id", text_col: str = "content") -> DataFrame:
    """chunk id, place, question_id, question, question_type, rationale: the questions that ``ask`` finds in the first 2,000
    characters and ``keep`` picks by place from 1, in its order and as often as it names them. Ids number all questions
    asked, so those that are left out leave gaps; places out of range are dropped."""
    easy = easy_count(n, easy_ratio)
    kind = "asked array<struct<question:string,question_type:string,rationale:string>>, kept array<int>"

    def one(row: dict) -> dict:
        content = row["content"] or ""
        asked = ask(content[:2000], easy, n - easy)
        return {"asked": asked, "kept": keep(content[:1000], [q["question"] for q in asked]) if asked else []}

    rows = model_columns(df.select(F.col(id_col).alias("chunk_id"), F.col(text_col).alias("content")), kind, one, ["content"])
    picked = rows.select("chunk_id", "asked", F.posexplode("kept").alias("place", "k")).where("k between 1 and size(asked)")
    return picked.select("chunk_id", (F.col("place") + 1).cast("long").alias("place"), F.concat(F.col("chunk_id").cast("string"), F.lit("_q"), F.col("k").cast("string")).alias("question_id"), F.get("asked", F.col("k") - 1).alias("q")).select("chunk_id", "place", "question_id", "q.*")


def first_questions(content: str, easy: int, medium: int) -> list[dict]:
    """The offline model for questions: one about each of the first sentences."""
    told = [s for s in content.split(". ") if s][: easy + medium]
    return [{"question": f"What is said by: {s}", "question_type": "easy" if k < easy else "medium", "rationale": f"sentence {k + 1}"} for k, s in enumerate(told)]


def keep_long(content: str, questions: list[str]) -> list[int]:
    """The offline filter: every second question, last first, then the first one again and one that isn't there."""
    return [*range(len(questions) - len(questions) % 2, 0, -2), 1, len(questions) + 1]


def judged(df: DataFrame, judge: Callable[[dict], dict], columns: Sequence[str]) -> DataFrame:
    """``df`` with the six scores of ``judge``, their mean ``overall``, and ``status``: 'ok', 'quarantined' for a score that is
    missing or not within 0 and 1 (then ``overall`` is null), or 'error'."""
    rows = model_columns(df, ", ".join(f"{s} double" for s in SCORES), judge, columns)
    valid = F.lit(True)
    for s in SCORES:
        valid = valid & F.coalesce(F.col(s).between(0.0, 1.0), F.lit(False))
    mean = sum((F.col(s) for s in SCORES), F.lit(0.0)) / len(SCORES)
    status = F.when(F.col("error").isNotNull(), "error").when(valid, "ok").otherwise("quarantined")
    return rows.withColumns({"overall": F.when(valid, mean), "status": status})


def definitions(df: DataFrame, find: Callable[[dict], dict], columns: Sequence[str], confidence: float = 0.7) -> DataFrame:
    """The rows in which ``find`` sees a function's definition with enough confidence, with ``name`` and ``confidence``."""
    rows = model_columns(df, "has_function_def boolean, name string, confidence double", find, columns)
    return rows.where((F.col("has_function_def")) & (F.col("confidence") >= confidence) & F.col("name").isNotNull()).drop("has_function_def", "error")
