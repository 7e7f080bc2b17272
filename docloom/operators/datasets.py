"""Queries over stored metadata, positions and reviews, added to those of ``queries``."""

from __future__ import annotations

from pyspark.sql import functions as F

from docloom.operators.adjacency import neighbours, positions
from docloom.operators.queries import CHUNKS_SQL, GLOBAL_SQL, ORACLE_SQL, QUERIES, chunks, query
from docloom.session import table
from docloom.sources import sinks

__all__ = ["ORACLE_SQL", "QUERIES"]


@query(f"SELECT doc_id, source, chunk_index, row_number() OVER (ORDER BY doc_id) - 1 AS global_index FROM ({CHUNKS_SQL})")
def chunk_index(spark, sf_dir):
    """Numbers within the source and in the whole collection."""
    return positions(chunks(spark, sf_dir).select("doc_id", "source", "chunk_index"), [], "doc_id", "global_index")


BLOCK_SQL = "'# SOURCE: ' || source || '/' || doc_id || '.md' || chr(10) || '# TIMESTAMP: 2024-01-01T00:00:00Z' || chr(10) || '# FORMAT: .md' || chr(10) || '---' || chr(10) || coalesce(text, '')"


@query(f"SELECT doc_id, sha256(CASE WHEN doc_id = (SELECT min(doc_id) FROM documents) THEN '' ELSE repeat(chr(10), 2) || repeat('=', 80) || repeat(chr(10), 2) END || {BLOCK_SQL}) AS block_sha256 FROM documents")
def consolidate(spark, sf_dir):
    """Digests of the blocks of the consolidated file, in the order of ids."""
    path = F.concat(F.col("source"), F.lit("/"), F.col("doc_id"), F.lit(".md"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    blocks = sinks.consolidated(docs, "doc_id", sinks.block(path, F.lit(".md"), F.col("text"), F.lit("2024-01-01T00:00:00Z")))
    return blocks.select("doc_id", F.sha2("block", 256).alias("block_sha256"))


@query("SELECT event_id, k AS field, json_extract_string(props, '$.\"' || k || '\"') AS value FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events) WHERE k NOT IN ('_id', 'question', 'answer', 'verified')")
def middle_fields(spark, sf_dir):
    """All fields of a record but the fixed ones, a row each."""
    held = F.from_json("props", "map<string,string>")
    kept = F.map_filter(held, lambda k, _: ~k.isin("_id", "question", "answer", "verified"))
    return table(spark, sf_dir, "events").select("event_id", F.explode(kept).alias("field", "value"))


@query(f"SELECT doc_id, list_aggregate(list_sort(list_distinct(list_concat([doc_id, doc_id % 10], CASE WHEN next_id IS NULL THEN [] ELSE [next_id] END))), 'string_agg', ',') AS sources FROM ({GLOBAL_SQL})")
def source_union(spark, sf_dir):
    """Ids a tool found and ids an answer cites, each once."""
    near = neighbours(table(spark, sf_dir, "documents").select("doc_id"), [], "doc_id")
    cited = F.array_compact(F.array("next_id"))
    return near.select("doc_id", F.array_join(F.array_sort(F.array_union(F.array("doc_id", F.col("doc_id") % 10), cited)).cast("array<string>"), ",").alias("sources"))


@query("SELECT item, event_id, old, new FROM (SELECT user_id AS item, event_id, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS old, event_type AS new FROM events) WHERE old IS DISTINCT FROM new")
def review_changes(spark, sf_dir):
    """Changes of status; an event that repeats the item's status is none."""
    log = table(spark, sf_dir, "events").select(F.col("user_id").alias("item"), "event_id", F.col("event_type").alias("new"))
    before = log.select(F.col("event_id").alias("previous_id"), F.col("new").alias("old"))
    near = neighbours(log, ["item"], "event_id").join(before, "previous_id", "left")
    return near.where(~F.col("old").eqNullSafe(F.col("new"))).select("item", "event_id", "old", "new")


@query("SELECT page_id, CASE WHEN s IN ('.htm', '.html') THEN 'html' WHEN s IN ('.docx', '.pptx', '.xlsx', '.pdf', '.md', '.txt') THEN substr(s, 2) ELSE 'unsupported' END AS format FROM (SELECT page_id, lower(regexp_extract(url, '(\\.[^./?]+)(\\?.*)?$', 1)) AS s FROM pages)")
def format_dispatch(spark, sf_dir):
    """The converter that a page's address asks for."""
    s = F.lower(F.regexp_extract("url", r"(\.[^./?]+)(\?.*)?$", 1))
    known = F.when(s.isin(".htm", ".html"), "html").when(s.isin(".docx", ".pptx", ".xlsx", ".pdf", ".md", ".txt"), F.substring(s, 2, 9))
    return table(spark, sf_dir, "pages").select("page_id", known.otherwise("unsupported").alias("format"))