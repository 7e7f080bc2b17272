"""From chunks to a dataset of questions, answers and scores."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from docloom.config import DatasetConfig
from docloom.operators import agents
from docloom.operators.adjacency import numbered
from docloom.plans import rounds
from docloom.plans.rounds import Rounds
from docloom.session import Staged


def assemble(questions: DataFrame, answers: DataFrame, timestamp: str) -> DataFrame:
    """Dataset entries: answers with their questions (of questions with one id the last, by ``place``), numbered by question
    id; answers without a question are left out. An answer has question_id, answer, trace, sources, iterations, scores."""
    last = questions.groupBy("question_id").agg(F.max_by(F.struct("question", "question_type", "rationale"), "place").alias("q"))
    joined = numbered(answers.join(last, "question_id"), ["question_id"], "at")
    return joined.select(
        F.concat(F.lit("entry_"), F.col("at").cast("string")).alias("id"), "q.question", "answer", F.col("trace").alias("reasoning"), "q.question_type", F.col("sources").alias("source_chunks"), F.struct("q.rationale", "iterations").alias("metadata"), F.col("scores").alias("quality_scores"), F.lit(timestamp).alias("generation_timestamp"),
    )


@dataclass(frozen=True)
class Dataset:
    """``entries``; ``failures`` (question_id, step, error) of calls that kept failing; ``counts``, taken while tables were written."""

    entries: DataFrame
    failures: DataFrame
    counts: dict[str, int]


def build_all(chunks: DataFrame, config: DatasetConfig, ask: Callable, keep: Callable, answer: Callable[[dict], dict] | Rounds, judge: Callable[[dict], dict], timestamp: str) -> Dataset:
    """Questions of every chunk (or of ``limit`` of them, for a trial), an answer each, its scores by ``judge``, and the entries of those that
    reach the threshold. ``answer`` makes answer, trace, sources and iterations of a question, or says how it is answered in rounds. Model calls are
    made once: their results are staged before they are used again."""
    if config.limit is not None:
        chunks = chunks.orderBy("chunk_id").limit(config.limit)
    asked = agents.generate_questions(chunks.select("chunk_id", "content"), ask, keep, config.questions_per_chunk, config.easy_question_ratio)
    seen = [Observation() for _ in range(3)]
    questions = Staged(asked.observe(seen[0], F.count(F.lit(1)).alias("n")), "questions").df
    if isinstance(answer, Rounds):
        single = questions.groupBy("question_id").agg(F.max_by(F.struct("question", "chunk_id"), "place").alias("q")).select("question_id", "q.*")
        answered = rounds.answers(single.select("question_id", "question"), answer).join(single, "question_id")
    else:
        schema = "answer string, trace string, sources array<string>, iterations int"
        answered = agents.model_columns(questions.select("question_id", "question", "chunk_id"), schema, answer, ["question", "chunk_id"])
    failed = F.count_if(F.col("error").isNotNull())
    answered = Staged(answered.observe(seen[1], failed.alias("failed"), (F.count(F.lit(1)) - failed).alias("n")), "answered").df
    accepted = F.count_if(F.col("overall") >= config.answer_quality_threshold).alias("n")
    judged = Staged(agents.judged(answered.where("error is null").drop("error"), judge, ["question", "answer"]).observe(seen[2], accepted), "answers").df
    good = judged.where(F.col("overall") >= config.answer_quality_threshold)
    scored = good.withColumn("scores", F.struct(*agents.SCORES, "overall")).withColumn("sources", F.array_sort(F.array_union("sources", F.array(F.col("chunk_id").cast("string")))))
    of = lambda df, step: df.where("error is not null").select("question_id", F.lit(step).alias("step"), "error")
    counts = {"questions": seen[0].get["n"], "answered": seen[1].get["n"], "failed": seen[1].get["failed"], "accepted": seen[2].get["n"]}
    return Dataset(assemble(questions, scored, timestamp), of(answered, "answer").unionByName(of(judged, "judge")), counts)


def build(chunks: DataFrame, config: DatasetConfig, ask: Callable, keep: Callable, answer: Callable[[dict], dict] | Rounds, judge: Callable[[dict], dict], timestamp: str) -> DataFrame:
    """The entries of ``build_all``."""
    return build_all(chunks, config, ask, keep, answer, judge, timestamp).entries
