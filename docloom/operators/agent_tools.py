"""Tools of answers in rounds: functions of a table of calls (question_id, k, args as JSON), answered by joins.

Defined results: arguments that are no JSON, or lack what a tool needs, are answered by an error text, as is a link or a
target that is not there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.operators import points
from docloom.operators.vector_index import Index
from docloom.session import Staged


def link_tool(links: DataFrame, chunks: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """Follows the link of a chunk: args {chunk_id, direction: next or prev}. ``links`` has id, next_id, prev_id (and next_relation and so on, if there
    are any), ``chunks`` id and content; ids are compared as text."""
    sides = []
    for side in ("next", "prev"):
        extra = [F.col(c).cast("string").alias(name) if c in links.columns else F.lit(None).cast("string").alias(name) for c, name in ((f"{side}_relation", "relation"), (f"{side}_topic", "topic"))]
        sides.append(links.select(F.col("id").cast("string").alias("from_id"), F.lit(side).alias("direction"), F.col(f"{side}_id").cast("string").alias("to_id"), *extra))
    edges = sides[0].unionByName(sides[1])
    targets = chunks.select(F.col("id").cast("string").alias("to_id"), F.col("content").alias("content"), F.lit(True).alias("there"))

    def call(calls: DataFrame) -> DataFrame:
        arg = lambda name: F.get_json_object("args", f"$.{name}")
        asked = calls.select("question_id", "k", arg("chunk_id").alias("from_id"), F.coalesce(arg("direction"), F.lit("next")).alias("direction"))
        found = asked.join(edges, ["from_id", "direction"], "left").join(targets, "to_id", "left")
        told = F.to_json(F.struct(F.col("to_id").alias("chunk_id"), F.substring("content", 1, 500).alias("content"), "relation", F.col("topic").alias("common_topic")))
        error = F.when(F.col("to_id").isNull(), F.concat(F.lit("Error: no "), "direction", F.lit(" link"))).otherwise("Error: linked chunk not found")
        return found.select("question_id", "k", F.when(F.col("there"), F.concat(F.lit("["), told, F.lit("]"))).otherwise(error).alias("result"))

    return call


def search_tool(index: Index, chunks: DataFrame, embed: Callable[[list[str]], list[list[float]]], k: int = 5) -> Callable[[DataFrame], DataFrame]:
    """Searches the index: args {query}. ``chunks`` has vec_id (as in the index) and content; hits come as a JSON list, the nearest first."""

    def call(calls: DataFrame) -> DataFrame:
        asked = calls.select("question_id", F.col("k").alias("call"), F.get_json_object("args", "$.query").alias("query"))
        asked = Staged(asked.withColumn("vec_id", F.xxhash64("question_id", "call")), "searches").df
        vectors = points.embed(asked.where("query is not null"), "query", embed).select("vec_id", "embedding")
        hits = index.search(vectors, k).join(chunks.select("vec_id", "content"), "vec_id")
        shown = F.struct("place", F.struct(F.col("vec_id").cast("string").alias("chunk_id"), F.substring("content", 1, 500).alias("content"), "distance").alias("hit"))
        listed = hits.groupBy(F.col("query_id").alias("vec_id")).agg(F.array_sort(F.collect_list(shown)).alias("hits")).select("vec_id", F.to_json(F.transform("hits", lambda h: h["hit"])).alias("found"))
        error = F.when(F.col("query").isNull(), F.lit("Error: no query")).otherwise("[]")
        return asked.join(listed, "vec_id", "left").select("question_id", F.col("call").alias("k"), F.coalesce("found", error).alias("result"))

    return call


