"""Summary points of chunks: links set by verdicts, text for embedding, topics, and calls of models in batches.

A point is ``struct<text, prev_link, next_link>``, a link ``struct<chunk_id, chunk_index, relation, common_topic>``.
All but the model calls are expressions on one row.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LINK = "struct<chunk_id:{},chunk_index:bigint,relation:string,common_topic:string>"
#: What a chunk gets whose summary failed.
FAILED = ["Summary generation failed"]


def points(texts: Column, id_type: str = "bigint") -> Column:
    """Points without links; a missing text is empty. Chunk ids are of ``id_type``."""
    none = F.lit(None).cast(LINK.format(id_type))
    return F.transform(texts, lambda t: F.struct(F.coalesce(t, F.lit("")).alias("text"), none.alias("prev_link"), none.alias("next_link")))


def set_links(found: Column, side: str, verdicts: Column, chunk_id: Column, chunk_index: Column) -> Column:
    """Points with ``side`` ('prev_link' or 'next_link') set where the verdict at the same place relates. Verdicts are
    ``struct<relates, relation, common_topic>``; more or fewer of them than points do no harm, their nulls are empty."""

    def one(point: Column, i: Column) -> Column:
        verdict = F.get(verdicts, i)
        link = F.struct(chunk_id.alias("chunk_id"), chunk_index.cast("long").alias("chunk_index"), F.coalesce(verdict["relation"], F.lit("")).alias("relation"), F.coalesce(verdict["common_topic"], F.lit("")).alias("common_topic"))
        return point.withField(side, F.when(verdict["relates"] & chunk_id.isNotNull(), link).otherwise(point[side]))

    return F.transform(found, one)


def first_link(found: Column, side: str) -> Column:
    """The first link of a side, or null."""
    return F.get(F.filter(F.transform(found, lambda p: p[side]), lambda x: x.isNotNull()), F.lit(0))


def topics(found: Column, side: str) -> Column:
    """The distinct topics of a side's links, sorted."""
    return F.array_sort(F.array_distinct(F.transform(F.filter(found, lambda p: p[side].isNotNull()), lambda p: p[side]["common_topic"])))


def embedding_text(content: Column, found: Column) -> Column:
    """The content and, if there are points, their numbered list with what links them."""

    def context(link: Column, before: str) -> Column:
        return F.when(link.isNotNull(), F.concat(F.lit(f"   ({before}: "), link["relation"], F.lit(" regarding "), link["common_topic"], F.lit(")\n"))).otherwise("")

    def shown(p: Column, i: Column) -> Column:
        return F.concat((i + 1).cast("string"), F.lit(". "), p["text"], F.lit("\n"), context(p["prev_link"], "Context from previous"), context(p["next_link"], "Leads to"))

    listed = F.array_join(F.transform(found, shown), "")
    text = F.coalesce(content, F.lit(""))
    return F.when(F.size(found) > 0, F.concat(text, F.lit("\n\n\nKey Points:\n"), listed)).otherwise(text)


def retrying(call: Callable, *args: object, tries: int = 3, base: float = 1.0) -> object:
    """``call(*args)``, tried again after ``base``, 2 ``base``, ... seconds; the last error is raised."""
    for k in range(tries):
        try:
            return call(*args)
        except Exception:
            if k == tries - 1:
                raise
            time.sleep(base * 2**k)
    raise ValueError("tries must be at least 1")


def summarise(df: DataFrame, text_col: str, model: Callable[[str], list[str]], tries: int = 3, base: float = 1.0) -> DataFrame:
    """Adds ``summary`` (array of strings): what ``model`` says of each text. Null texts count as empty; a text whose
    calls all fail gets the one point FAILED, not a failed job."""

    @F.arrow_udf("array<string>")
    def run(column: pa.Array) -> pa.Array:
        def one(text: str | None) -> list[str]:
            try:
                return list(retrying(model, text or "", tries=tries, base=base))
            except Exception:  # noqa: BLE001 - a model's fault is that row's
                return FAILED

        return pa.array(map(one, column.to_pylist()), pa.list_(pa.string()))

    return df.withColumn("summary", run(text_col))


def embed(df: DataFrame, text_col: str, model: Callable[[list[str]], list[list[float]]], batch: int = 32) -> DataFrame:
    """Adds ``embedding``: ``model`` is called on at most ``batch`` texts at a time, in order; its errors fail the job."""

    @F.arrow_udf("array<float>")
    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in parts:
            made = [pa.array(model([t or "" for t in column.slice(k, batch).to_pylist()]), pa.list_(pa.float32())) for k in range(0, len(column), batch)]
            yield pa.concat_arrays(made) if made else pa.array([], pa.list_(pa.float32()))

    return df.withColumn("embedding", run(text_col))


def lead_sentences(text: str, n: int = 3) -> list[str]:
    """The offline model for summaries: the first sentences."""
    return [s for s in (s.strip() for s in text.split(". ")) if s][:n]
