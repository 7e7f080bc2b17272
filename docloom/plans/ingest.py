"""From a folder of files to a store of linked, embedded chunks, as one plan whose costly steps are kept.

The same plan serves a folder at once (``ingest``) and files as they arrive (``streaming.ingest``): both give a batch to the store, which
replaces what an earlier run of that batch has left.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from docloom.config import IngestConfig
from docloom.operators import agents, chunking, points, relations
from docloom.operators.adjacency import numbered
from docloom.session import Staged
from docloom.sources import consolidated, sinks
from docloom.sources.cache import cached, purge
from docloom.sources.converters import convert, folder
from docloom.sources.store import Batch, Store, put_numbered

VERDICTS = "array<struct<relates:boolean,relation:string,common_topic:string>>"


@dataclass(frozen=True)
class Models:
    """What the plan calls: ``embed`` of texts, and, where chunks are linked, ``summary`` of a text and ``relate`` of a text, its points and
    the neighbour's text (or ``RARE_TERMS``). ``converters`` has those of further suffixes."""

    embed: Callable[[list[str]], list[list[float]]]
    summary: Callable[[str], list[str]] | None = None
    relate: Callable[[str, list[str], str], list[dict]] | str | None = None
    converters: dict[str, Callable[[bytes], str]] = field(default_factory=dict)


def numbered_chunks(files: DataFrame, size: int, overlap: int = 0, first: int = 0) -> DataFrame:
    """path, chunk_id, chunk_index (from ``first`` on through all files in the order of paths), place (in the file) and the columns of
    ``chunking.chunk`` of rows with path and markdown."""
    parts = chunking.chunk(files, "path", "markdown", size, overlap).withColumnRenamed("chunk_index", "place")
    counts = numbered(parts.groupBy("path").agg(F.count("*").alias("n")), ["path"], "before", "n")
    placed = parts.join(counts.select("path", "before"), "path").withColumn("chunk_index", F.lit(first) + F.col("before") + F.col("place"))
    return placed.withColumn("chunk_id", F.md5(F.concat_ws(":", "path", F.col("place").cast("string")))).drop("before")


#: Stands for a model of relations: neighbours relate by the rare terms that they share, counted over all chunks of the batch.
RARE_TERMS = "rare terms"


def _by_model(near: DataFrame, relate: Callable[[str, list[str], str], list[dict]], tries: int, base: float) -> DataFrame:
    """v_prev, v_next and link_error as ``relate`` gives them, in batches."""

    def one(row: dict) -> dict:
        out: dict = {"link_error": None}
        for name in ("prev", "next"):
            if row[name] is not None:
                try:
                    out[f"v_{name}"] = list(points.retrying(relate, row["content"] or "", row["summary"], row[name]["content"] or "", tries=tries, base=base))
                except Exception as e:  # noqa: BLE001 - a model's fault is that side's
                    out["link_error"] = f"{type(e).__name__}: {e}"
        return out

    return agents.model_columns(near, f"v_prev {VERDICTS}, v_next {VERDICTS}, link_error string", one, ["content", "summary", "prev", "next"]).drop("error")


def _by_terms(near: DataFrame) -> DataFrame:
    """The same from shared rare terms: the first point of a chunk is linked."""
    pairs = near.select(F.col("chunk_id").alias("from_id"), F.col("next.chunk_id").alias("to_id"))
    found = Staged(relations.related(pairs, relations.rare_terms(near.select("chunk_id", "content"), "chunk_id", "content")), "related").df
    verdict = F.array(F.struct(F.lit(True).alias("relates"), F.concat(F.lit("shares "), F.col("shared"), F.lit(" rare terms")).alias("relation"), F.col("topic").alias("common_topic")))
    ahead = found.select(F.col("from_id").alias("chunk_id"), verdict.alias("v_next"))
    back = found.select(F.col("to_id").alias("chunk_id"), verdict.alias("v_prev"))
    return near.join(ahead, "chunk_id", "left").join(back, "chunk_id", "left").withColumn("link_error", F.lit(None).cast("string"))


def linked(chunks: DataFrame, summary: Callable[[str], list[str]], relate: Callable[[str, list[str], str], list[dict]] | str, tries: int = 3, base: float = 0.0) -> DataFrame:
    """``chunks`` with summary_points, of every chunk and related to the chunk before and after it in its file, and link_error. Models are called in
    batches; where ``relate`` keeps failing for a side, that side has no links. ``relate`` may be ``RARE_TERMS``."""
    told = Staged(points.summarise(chunks, "content", summary, tries, base), "summaries").df
    by = Window.partitionBy("path").orderBy("place")
    side = lambda f: f(F.struct("chunk_id", "chunk_index", "content")).over(by)
    near = told.withColumns({"prev": side(F.lag), "next": side(F.lead)})
    near = _by_terms(near) if relate == RARE_TERMS else _by_model(near, relate, tries, base)
    made = points.points(F.col("summary"), "string")
    for name in ("prev", "next"):
        made = points.set_links(made, f"{name}_link", F.col(f"v_{name}"), F.col(f"{name}.chunk_id"), F.col(f"{name}.chunk_index"))
    return near.withColumn("summary_points", made).drop("summary", "prev", "next", "v_prev", "v_next")


def stored_chunks(good: DataFrame, config: IngestConfig, models: Models, first: int = 0) -> DataFrame:
    """The store's rows of files (path, markdown), numbered from ``first`` on: chunked, linked and embedded, with flat metadata."""
    chunks = numbered_chunks(good, config.chunk_size, config.chunk_overlap, first)
    if config.link:
        chunks = linked(chunks, models.summary, models.relate)
    else:
        chunks = chunks.withColumns({"summary_points": points.points(F.array().cast("array<string>"), "string"), "link_error": F.lit(None).cast("string")})
    with_summary = config.link and config.embed_with_summary
    text = points.embedding_text(F.col("content"), F.col("summary_points")) if with_summary else F.col("content")
    chunks = Staged(chunks, "chunks").df.withColumn("embedded_text", text)  # worked out when read: staged, most contents would be written twice
    vectors = lambda rows: points.embed(rows, "embedded_text", models.embed)
    if config.cache_dir:
        chunks = cached(chunks, f"{config.cache_dir}/embeddings", ["embedded_text"], vectors, ["embedding"], "with_summary" if with_summary else "")
    else:
        chunks = vectors(chunks)
    extras: dict[str, Column] = {"header_levels": F.col("header_levels"), "part_of_large_para": F.col("large_paragraph"), "truncated": F.col("truncated"), "link_error": F.col("link_error")}
    flat = sinks.metadata(F.col("path"), F.col("chunk_index"), F.col("start_char"), F.col("end_char"), F.col("headers"), F.col("summary_points"), **extras)
    return chunks.select(F.lit(config.collection).alias("collection"), F.col("chunk_id").alias("id"), F.col("content").alias("document"), "embedding", *flat)


def markdown_of(files: DataFrame, config: IngestConfig, models: Models) -> tuple[DataFrame, int]:
    """path, markdown of the files that could be converted, and how many could not: counted while they are written."""
    to_markdown = lambda rows: convert(rows, models.converters)
    if config.cache_dir:
        keep = lambda rows: to_markdown(rows.select("path", "content")).join(rows.select("path", "cache_key"), "path")
        files = cached(files, f"{config.cache_dir}/markdown", ["path", "content"], keep, ["markdown", "error"]).select("path", "markdown", "error")
    else:
        files = to_markdown(files)
    seen = Observation()
    held = Staged(files.select("path", "markdown", "error").observe(seen, F.count_if(F.col("error").isNotNull()).alias("failed")), "markdown").df
    return held.where("error is null").select("path", "markdown"), seen.get["failed"]


def store_batch(store: Store, batch: str, good: DataFrame, config: IngestConfig, models: Models) -> Batch:
    """Chunk files and put them in the store as a batch, numbered after what is there."""
    measures = {"summarised": F.count("summary_points"), "failed_links": F.count("link_error")}
    return put_numbered(store, config.collection, batch, lambda first: stored_chunks(good, config, models, first), "chunk_index", measures=measures)


def ingest(spark: SparkSession, config: IngestConfig, embed: Callable[[list[str]], list[list[float]]], models: dict[str, Callable] | None = None, converters: dict[str, Callable[[bytes], str]] | None = None, timestamp: str | None = None) -> dict[str, object]:
    """Convert, consolidate, chunk, number, link, embed and store; returns paths and counts. The folder is one batch of the store: a second run
    takes the first one's place. With ``cache_dir``, files and texts that an earlier run has seen are neither converted nor embedded again,
    whatever their place."""
    config.check(models or {})
    called = Models(embed, (models or {}).get("summary"), (models or {}).get("relate"), converters or {})
    good, failed = markdown_of(folder(spark, config.input_dir, config.formats), config, called)
    made = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'") if timestamp is None else F.lit(timestamp)
    suffix = F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1))
    if config.append:
        runs = Store(spark, f"{config.output_dir}/consolidated_runs")
        consolidated.append(runs, good.withColumn("suffix", suffix), f"run-{uuid.uuid4().hex}", made)
        consolidated.export(runs, f"{config.output_dir}/consolidated")
    else:
        sinks.write_consolidated(sinks.consolidated(good, "path", sinks.block(F.col("path"), suffix, F.col("markdown"), made)), "path", f"{config.output_dir}/consolidated")
    store = Store(spark, f"{config.output_dir}/store")
    batch = store_batch(store, f"folder-{hashlib.md5(config.input_dir.encode()).hexdigest()}", good, config, called)
    if config.cache_dir and config.cleanup_cache:
        for step in ("markdown", "embeddings"):
            purge(good, f"{config.cache_dir}/{step}")
    counts = {"failed_files": failed, "total_chunks": store.collections()[config.collection], "chunks_with_summaries": batch.measures["summarised"], "failed_links": batch.measures["failed_links"]}
    return {"store": store.path, "consolidated": f"{config.output_dir}/consolidated", **counts}
