"""Queries over the vector index, the chunk store, the undo stack of reviews and answers in rounds, added to those of ``agent_queries``."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.config import IngestConfig
from docloom.operators import undo, vector_index
from docloom.operators.agent_queries import ORACLE_SQL, QUERIES
from docloom.operators.agent_tools import link_tool
from docloom.operators.link_queries import LINKS_SQL, digest_vectors, links
from docloom.operators.markdown_queries import chunks_sql
from docloom.operators.queries import query
from docloom.plans.ingest import Models, store_batch
from docloom.plans.rounds import Rounds, traces
from docloom.session import Staged, shared_dir, table
from docloom.sources.store import Store

__all__ = ["ORACLE_SQL", "QUERIES"]


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", "embedding")


@query("SELECT vec_id, 1::BIGINT AS entries, round(embedding[1]::DOUBLE, 6) AS first FROM embeddings WHERE list_sum(list_transform(embedding, lambda x: abs(x))) > 0")
def index_members(spark, sf_dir):
    """What the index holds: every vector with a direction, once."""
    held = vector_index.build(vectors(spark, sf_dir)).members()
    return held.groupBy("vec_id").agg(F.count("*").alias("entries"), F.round(F.max(F.col("embedding")[0]).cast("double"), 6).alias("first"))


@query(ORACLE_SQL["vector_knn"])
def index_exact(spark, sf_dir):
    """The index with all its lists probed: exact neighbours of every vector whose id is divisible by 20."""
    index = vector_index.build(vectors(spark, sf_dir))
    return index.search(vectors(spark, sf_dir).where("vec_id % 20 = 0"), 5, max(1, len(index.centres)))


@query()
def index_search(spark, sf_dir):
    """The same from as many lists as were fitted: approximate."""
    return vector_index.build(vectors(spark, sf_dir)).search(vectors(spark, sf_dir).where("vec_id % 20 = 0"), 5)


#: Events as a review log: errors are undos, every 97th event is a save, the others are changes.
LOG_SQL = "SELECT event_id, user_id, event_type, CASE WHEN event_id % 97 = 0 THEN 'save' WHEN event_type = 'error' THEN 'undo' ELSE 'change' END AS kind FROM events"
#: The depth of the stack by running sums within what lies between saves; changes and the undos that find them follow each other at a level.
UNDO_SQL = f"""
SELECT event_id, user_id, event_type, CASE WHEN after_kind = 'undo' THEN after_id END AS undone_by
FROM (SELECT *, lead(kind) OVER l AS after_kind, lead(event_id) OVER l AS after_id
    FROM (SELECT *, CASE WHEN kind = 'change' THEN depth ELSE depth + 1 END AS level FROM
        (SELECT *, coalesce(lag(depth) OVER (PARTITION BY part ORDER BY event_id), 0) AS before FROM
            (SELECT *, s - least(0, min(s) OVER (PARTITION BY part ORDER BY event_id)) AS depth FROM
                (SELECT *, sum(CASE kind WHEN 'change' THEN 1 ELSE -1 END) OVER (PARTITION BY part ORDER BY event_id) AS s FROM
                    (SELECT *, count(*) FILTER (kind = 'save') OVER (ORDER BY event_id) AS part FROM ({LOG_SQL})) WHERE kind <> 'save')))
        WHERE kind = 'change' OR before > 0)
    WINDOW l AS (PARTITION BY part, level ORDER BY event_id))
WHERE kind = 'change'"""


def review_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("event_id") % 97 == 0, "save").when(F.col("event_type") == "error", "undo").otherwise("change")
    return table(spark, sf_dir, "events").select(F.col("event_id").cast("long").alias("seq"), kind.alias("kind"), F.col("user_id").alias("item"), F.lit(None).cast("string").alias("old"), F.col("event_type").alias("new"))


@query(f"SELECT event_id, undone_by FROM ({UNDO_SQL})")
def review_undo_stack(spark, sf_dir):
    """Every change with the undo that takes it back, by one stack over all items."""
    return undo.matched(review_log(spark, sf_dir)).withColumnRenamed("seq", "event_id")


@query(f"SELECT user_id AS item, arg_max(event_type, event_id) FILTER (undone_by IS NULL) AS status FROM ({UNDO_SQL}) GROUP BY user_id")
def review_standing(spark, sf_dir):
    """The status that every item is left with."""
    return undo.statuses(review_log(spark, sf_dir))


#: Documents under titles, one of which has the mark that joins titles, and without any.
TITLED_SQL = "SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN '# A > B' || chr(10) WHEN 1 THEN '' ELSE '# t' || chr(10) || '### u > v' || chr(10) END || coalesce(text, '') AS md FROM documents"


@query(
    f"SELECT md5(path || ':' || place) AS id, (row_number() OVER (ORDER BY path, place) - 1)::VARCHAR AS chunk_index, path AS source_file, content AS document, '0' AS start_char, end_char::VARCHAR AS end_char,"
    " CASE doc_id % 3 WHEN 0 THEN '[\"A > B\"]' WHEN 1 THEN '[]' ELSE '[\"t\",\"u > v\"]' END AS headers, CASE WHEN doc_id % 3 = 1 OR large_paragraph THEN '[]' WHEN doc_id % 3 = 0 THEN '[1]' ELSE '[1,3]' END AS header_levels, large_paragraph AS part_of_large_para, truncated"
    f" FROM (SELECT *, 'docs/' || doc_id || '.md' AS path, chunk_index AS place FROM ({chunks_sql(TITLED_SQL, 400)}))"
)
def chunk_store(spark, sf_dir):
    """The rows of a store after two runs over the same documents."""
    k = F.col("doc_id") % 3
    head = F.when(k == 0, "# A > B\n").when(k == 1, "").otherwise("# t\n### u > v\n")
    files = table(spark, sf_dir, "documents").select(F.concat(F.lit("docs/"), "doc_id", F.lit(".md")).alias("path"), F.concat(head, F.coalesce("text", F.lit(""))).alias("markdown"))
    store = Store(spark, f"{shared_dir(spark)}/chunk-store-{uuid.uuid4().hex}")
    for _ in range(2):
        store_batch(store, "documents", files, IngestConfig(chunk_size=400), Models(digest_vectors))
    rows = Staged(store.read("docs"), "chunk-store").df
    store.drop("docs")
    return rows.select("id", "chunk_index", "source_file", "document", "start_char", "end_char", "headers", "header_levels", "part_of_large_para", "truncated")


def scripted(asked: list[list[dict]]) -> list[dict]:
    """The offline model: it follows links from the chunk that a question names, once or up to four times, as the id says; some
    questions it answers at once, and on some it fails."""

    def one(messages: list[dict]) -> dict:
        doc = int(messages[1]["content"].split("#")[1].split("\n")[0])
        told = [m["content"] for m in messages if m["role"] == "tool"]
        if doc % 13 == 5:
            raise RuntimeError("no answer")
        if doc % 7 == 3 or len(told) == 1 + doc % 4 or told and told[-1].startswith("Error"):
            return {"content": "done", "calls": []}
        at = json.loads(told[-1])[0]["chunk_id"] if told else str(doc)
        return {"content": "", "calls": [{"name": "get_linked_chunk", "args": json.dumps({"chunk_id": at, "direction": "next"})}]}

    return [one(m) for m in asked]


ROUNDS = 4
_WANTED = "CASE WHEN doc_id % 7 = 3 OR doc_id % 13 = 5 THEN 0 ELSE 1 + doc_id % 4 END"


@query(
    f"WITH RECURSIVE l AS MATERIALIZED (SELECT s.doc_id, s.next_id FROM ({LINKS_SQL}) s JOIN documents d ON d.doc_id = s.next_id),"
    f" w AS (SELECT doc_id AS start_id, doc_id AS here, 0 AS hop FROM documents UNION ALL SELECT w.start_id, l.next_id, hop + 1 FROM w JOIN l ON l.doc_id = w.here JOIN documents d ON d.doc_id = w.start_id WHERE hop < least({ROUNDS - 1}, {_WANTED.replace('doc_id', 'd.doc_id')})),"
    f" m AS (SELECT start_id AS doc_id, max(hop) AS hops, coalesce(string_agg(here::VARCHAR, ',' ORDER BY hop) FILTER (hop > 0), '') AS visited FROM w GROUP BY start_id)"
    f" SELECT doc_id, CASE WHEN doc_id % 13 = 5 OR {_WANTED} = 0 THEN 1 ELSE least({ROUNDS}, CASE WHEN hops = {_WANTED} THEN hops ELSE hops + 1 END + 1) END::BIGINT AS iterations, visited, doc_id % 13 = 5 AS failed FROM m"
)
def answer_rounds(spark, sf_dir):
    """Questions about all documents, answered in rounds by a scripted model that follows links."""
    docs = table(spark, sf_dir, "documents")
    near = Staged(links(spark, sf_dir).select(F.col("doc_id").alias("id"), "next_id", "prev_id"), "links").df
    tools = {"get_linked_chunk": link_tool(near, docs.select(F.col("doc_id").alias("id"), F.col("text").alias("content")))}
    asked = docs.select(F.col("doc_id").cast("string").alias("question_id"), F.concat(F.lit("What follows #"), "doc_id").alias("question"))
    held = traces(asked, Rounds(scripted, tools, lambda row: {"answer": row["context"]}, ROUNDS, wait=0.0))
    told = F.filter("messages", lambda m: (m["role"] == "tool") & ~F.startswith(m["content"], F.lit("Error")))
    ids = F.transform(told, lambda m: F.get_json_object(m["content"], "$[0].chunk_id"))
    return held.select(F.col("question_id").cast("long").alias("doc_id"), F.col("iterations").cast("long").alias("iterations"), F.array_join(ids, ",").alias("visited"), F.col("error").isNotNull().alias("failed"))
