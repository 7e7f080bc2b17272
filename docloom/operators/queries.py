"""Queries over chunks, vectors, scores and reviews, with the SQL that gives the same rows.

``documents`` stand in for chunks (numbered within their source by id), ``events`` for a review log
(event_type is the new status, user_id the item, event_id the order), ``labels`` for judge scores and
``conversations`` for message traces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions.text import ellipsis
from docloom.operators import vectors
from docloom.operators.adjacency import neighbours, positions
from docloom.session import table

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


CHUNKS_SQL = "SELECT doc_id, source, text, n_chars, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS chunk_index FROM documents"


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, source, chunk_index: texts are not numbered along with their ids."""
    return positions(table(spark, sf_dir, "documents").select("doc_id", "source"), ["source"], "doc_id")


@query(f"SELECT doc_id, source, chunk_index, md5(source || ':' || chunk_index) AS chunk_id FROM ({CHUNKS_SQL})")
def chunk_id(spark, sf_dir):
    return chunks(spark, sf_dir).select("doc_id", "source", "chunk_index", F.md5(F.concat_ws(":", "source", "chunk_index")).alias("chunk_id"))


@query("SELECT doc_id, source, n_chars FROM documents WHERE source = 'src3'")
def chunks_by_source(spark, sf_dir):
    return table(spark, sf_dir, "documents").where("source = 'src3'").select("doc_id", "source", "n_chars")


@query("SELECT doc_id, source, text FROM documents WHERE doc_id = 7")
def chunk_by_id(spark, sf_dir):
    return table(spark, sf_dir, "documents").where("doc_id = 7").select("doc_id", "source", "text")


@query(f"SELECT doc_id, source, chunk_index FROM ({CHUNKS_SQL}) WHERE chunk_index = 5")
def chunk_by_index(spark, sf_dir):
    return chunks(spark, sf_dir).where("chunk_index = 5").select("doc_id", "source", "chunk_index")


@query("SELECT source, count(*) AS n, min(doc_id) AS first_id FROM documents GROUP BY source")
def source_counts(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id"))


@query("SELECT lang AS collection, count(*) AS n FROM documents GROUP BY lang")
def collection_counts(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy(F.col("lang").alias("collection")).agg(F.count("*").alias("n"))


@query("SELECT source, doc_id, lag(doc_id) OVER w AS previous_id, lead(doc_id) OVER w AS next_id FROM documents WINDOW w AS (PARTITION BY source ORDER BY doc_id)")
def adjacent_pairs(spark, sf_dir):
    return neighbours(table(spark, sf_dir, "documents").select("source", "doc_id"), ["source"], "doc_id")


@query("SELECT doc_id, CASE WHEN length(text) > 300 THEN substr(text, 1, 300) || '...' ELSE text END AS preview FROM documents")
def preview(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", ellipsis(F.col("text"), 300).alias("preview"))


SCORES_SQL = "SELECT l.doc_id, quality, toxic, round((quality + (1 - toxic) + quality + 1 + (1 - toxic) + 0.5) / 6.0, 6)::DOUBLE AS overall FROM labels l"


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    q, t = F.col("quality"), F.col("toxic")
    return table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic", F.round((q + (1 - t) + q + 1 + (1 - t) + F.lit(0.5)) / 6.0, 6).alias("overall"))


@query(SCORES_SQL)
def judge_overall(spark, sf_dir):
    return scores(spark, sf_dir)


@query(f"SELECT doc_id, overall FROM ({SCORES_SQL}) WHERE overall >= 0.7")
def quality_filter(spark, sf_dir):
    return scores(spark, sf_dir).where("overall >= 0.7").select("doc_id", "overall")


@query("SELECT user_id AS item, arg_max(event_type, event_id) AS status, count(*) AS changes FROM events GROUP BY user_id")
def review_latest(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("item")).agg(F.max_by("event_type", "event_id").alias("status"), F.count("*").alias("changes"))


@query("SELECT item, arg_max(status, event_id) AS status FROM (SELECT user_id AS item, event_id, event_type AS status, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events) WHERE r > 1 GROUP BY item")
def review_undo(spark, sf_dir):
    """Statuses after each item's last change is taken back; items with one change have none."""
    log = table(spark, sf_dir, "events").select(F.col("user_id").alias("item"), "event_id", F.col("event_type").alias("status"))
    last = log.groupBy("item").agg(F.max("event_id").alias("event_id"))
    return log.join(last, ["item", "event_id"], "left_anti").groupBy("item").agg(F.max_by("status", "event_id").alias("status"))


@query("SELECT doc_id, md5(source || '/' || doc_id) AS path_key, sha256(text) AS content_key FROM documents")
def cache_key(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(F.concat_ws("/", "source", "doc_id")).alias("path_key"), F.sha2("text", 256).alias("content_key"))


@query("SELECT d.doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def cache_miss(spark, sf_dir):
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left_anti").select("doc_id")


@query(
    "WITH q AS (SELECT vec_id AS query_id, embedding AS a FROM embeddings WHERE vec_id % 20 = 0), s AS (SELECT query_id, vec_id, 1 - list_dot_product(a::DOUBLE[], embedding::DOUBLE[]) / sqrt(list_dot_product(a::DOUBLE[], a::DOUBLE[]) * list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS d FROM q, embeddings),"
    " r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(d, 6), vec_id) AS place FROM s) SELECT query_id, vec_id, place, round(d, 6) AS distance FROM r WHERE place <= 5"
)
def vector_knn(spark, sf_dir):
    """The five nearest vectors by cosine distance for every vector whose id is divisible by 20."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return vectors.nearest(rows.where("vec_id % 20 = 0"), rows, 5)


GLOBAL_SQL = "SELECT doc_id, lag(doc_id) OVER w AS previous_id, lead(doc_id) OVER w AS next_id FROM documents WINDOW w AS (ORDER BY doc_id)"


@query(GLOBAL_SQL)
def global_adjacency(spark, sf_dir):
    """Neighbours in the whole collection; no task holds more than a span of ids or one row per span."""
    return neighbours(table(spark, sf_dir, "documents").select("doc_id"), [], "doc_id")


@query(f"WITH g AS ({GLOBAL_SQL}), t AS (SELECT doc_id, 'previous' AS direction, previous_id AS found_id FROM g UNION ALL SELECT doc_id, 'next', next_id FROM g) SELECT t.doc_id, direction, found_id, d.n_chars FROM t JOIN documents d ON d.doc_id = found_id")
def adjacent_fetch(spark, sf_dir):
    near = global_adjacency(spark, sf_dir)
    wanted = near.select("doc_id", F.explode(F.create_map(F.lit("previous"), "previous_id", F.lit("next"), "next_id")).alias("direction", "found_id"))
    target = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("found_id"), "n_chars")
    return wanted.join(target, "found_id").select("doc_id", "direction", "found_id", "n_chars")