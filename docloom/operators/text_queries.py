"""Queries over embedded texts, ranked sentences, rare terms, graphs of nodes and consolidated runs, added to those of ``store_queries``."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.operators import embedder, points, relations, sentences
from docloom.operators.adjacency import neighbours
from docloom.operators.link_queries import walk
from docloom.operators.queries import query
from docloom.operators.store_queries import ORACLE_SQL, QUERIES
from docloom.operators.vectors import nearest
from docloom.session import Staged, shared_dir, table
from docloom.sources import consolidated, node_graph, reviews
from docloom.sources.store import Store

__all__ = ["ORACLE_SQL", "QUERIES"]


@query(
    "WITH w AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \\t\\n\\r\\f]+') AS w FROM documents),"
    " g AS (SELECT doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1]))) AS gram FROM w WHERE len(w) > 0)"
    f" SELECT bucket::INTEGER AS bucket, count(*) AS n FROM (SELECT DISTINCT doc_id, ('0x' || substr(md5(gram), 1, 5))::BIGINT % {embedder.BUCKETS} AS bucket FROM g) GROUP BY bucket"
)
def bucket_frequencies(spark, sf_dir):
    """How many documents hold each bucket of words and word pairs."""
    return embedder.frequencies(table(spark, sf_dir, "documents"), "text")


def embedded(spark: SparkSession, sf_dir: str, model: embedder.Embedder, name: str, key: str) -> DataFrame:
    return points.embed(table(spark, sf_dir, name).select(F.col(key).alias("vec_id"), "text"), "text", model).select("vec_id", "embedding")


@query()
def text_neighbours(spark, sf_dir):
    """The five documents nearest to each passage of the benchmark, by the embedder fitted on the documents."""
    model = embedder.fit(table(spark, sf_dir, "documents"), "text")
    return nearest(embedded(spark, sf_dir, model, "benchmark", "item_id"), embedded(spark, sf_dir, model, "documents", "doc_id"), 5).withColumnRenamed("vec_id", "doc_id")


@query()
def ranked_summaries(spark, sf_dir):
    """The weightiest sentences of every document as its points."""
    said = points.summarise(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", sentences.ranked)
    return said.select("doc_id", F.array_join("summary", "|").alias("summary"), F.size("summary").cast("long").alias("n_points"))


TERMS_SQL = f"SELECT DISTINCT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{relations.TERM}')) AS term FROM documents"
RELATED_SQL = f"""
SELECT from_id, to_id, count(*) AS shared, list_aggregate(list(a.term ORDER BY n, a.term)[1:{relations.TOPICS}], 'string_agg', ', ') AS topic
FROM (SELECT doc_id AS from_id, lead(doc_id) OVER (PARTITION BY source ORDER BY doc_id) AS to_id FROM documents) p
JOIN (SELECT t.doc_id, t.term, n FROM ({TERMS_SQL}) t JOIN (SELECT term, count(*) AS n FROM ({TERMS_SQL}) GROUP BY term HAVING count(*) > 1 AND count(*) <= greatest({relations.FEW}, (SELECT count(*) FROM documents) // {relations.RARE})) USING (term)) a ON a.doc_id = p.from_id
JOIN (SELECT doc_id, term FROM ({TERMS_SQL})) b ON b.doc_id = p.to_id AND b.term = a.term
GROUP BY from_id, to_id"""


def related(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents related to the next one of their source by rare terms."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    pairs = neighbours(docs.select("doc_id", "source"), ["source"], "doc_id").select(F.col("doc_id").alias("from_id"), F.col("next_id").alias("to_id"))
    return Staged(relations.related(pairs, relations.rare_terms(docs, "doc_id", "text")), "related").df


@query(RELATED_SQL)
def term_relations(spark, sf_dir):
    """Pairs of neighbouring documents that share rare terms, with the rarest as topic."""
    return related(spark, sf_dir)


@query(f"WITH r AS MATERIALIZED ({RELATED_SQL}) SELECT d.doc_id, n.to_id AS next_id, 'shares ' || n.shared || ' terms' AS next_relation, n.topic AS next_topic, p.from_id AS prev_id, p.topic AS prev_topic FROM documents d LEFT JOIN r n ON n.from_id = d.doc_id LEFT JOIN r p ON p.to_id = d.doc_id")
def related_links(spark, sf_dir):
    """The links that these relations give each document's first point."""
    found = related(spark, sf_dir)
    ahead = found.select(F.col("from_id").alias("doc_id"), F.col("to_id").alias("after"), F.concat(F.lit("shares "), "shared", F.lit(" terms")).alias("relation"), F.col("topic").alias("topic_after"))
    back = found.select(F.col("to_id").alias("doc_id"), F.col("from_id").alias("before"), F.col("topic").alias("topic_before"))
    rows = table(spark, sf_dir, "documents").select("doc_id").join(ahead, "doc_id", "left").join(back, "doc_id", "left")
    verdict = lambda to, relation, topic: F.array(F.struct(F.col(to).isNotNull().alias("relates"), relation.alias("relation"), F.col(topic).alias("common_topic")))
    made = points.points(F.array(F.lit("")))
    made = points.set_links(made, "next_link", verdict("after", F.col("relation"), "topic_after"), F.col("after"), F.lit(None).cast("long"))
    made = points.set_links(made, "prev_link", verdict("before", F.lit("follows"), "topic_before"), F.col("before"), F.lit(None).cast("long"))
    rows = rows.select("doc_id", points.first_link(made, "next_link").alias("n"), points.first_link(made, "prev_link").alias("p"))
    return rows.select("doc_id", F.col("n.chunk_id").alias("next_id"), F.col("n.relation").alias("next_relation"), F.col("n.common_topic").alias("next_topic"), F.col("p.chunk_id").alias("prev_id"), F.col("p.common_topic").alias("prev_topic"))


@query(f"WITH RECURSIVE r AS MATERIALIZED ({RELATED_SQL}), w AS (SELECT doc_id AS start_id, 0 AS hop, doc_id FROM documents UNION ALL SELECT w.start_id, hop + 1, r.to_id FROM w JOIN r ON r.from_id = w.doc_id WHERE hop < 3) SELECT * FROM w")
def related_walk(spark, sf_dir):
    """Up to three hops along these relations."""
    step = related(spark, sf_dir).select(F.col("from_id").alias("doc_id"), F.col("to_id").alias("next_id"))
    return walk(Staged(table(spark, sf_dir, "documents").select("doc_id").join(step, "doc_id", "left"), "steps").df, "next_id", 3)


@query(ORACLE_SQL["code_search"])
def graph_search(spark, sf_dir):
    """Nodes of a graph file by falling similarity, as ``code_search`` finds them in its table."""
    rows, label = table(spark, sf_dir, "embeddings"), F.col("label").cast("string")
    kind = F.when(F.col("label") % 3 == 0, "function").when(F.col("label") % 3 == 1, "class").otherwise("file")
    nodes = rows.select(F.col("vec_id").alias("id"), kind.alias("type"), F.concat(F.lit("node_"), "vec_id").alias("name"), F.repeat(F.concat(F.lit("about "), label, F.lit(" ")), F.lit(40)).alias("summary"), F.concat(F.lit("src/"), label, F.lit(".py")).alias("file_path"), F.when(F.col("vec_id") % 17 != 3, F.col("embedding")).alias("embedding"))
    edges = rows.where("vec_id > 0").select(F.col("vec_id").alias("source"), (F.col("vec_id") - 1).alias("target"))
    path = f"{shared_dir(spark)}/graph-{uuid.uuid4().hex}"
    node_graph.save(nodes, edges, path)
    graph = node_graph.load(spark, path, lines=True)
    held = graph.nodes.withColumn("vec_id", F.col("entity_id").cast("long"))
    hits = nearest(rows.where("vec_id % 20 = 0").select("vec_id", "embedding"), held.select("vec_id", "embedding"), 5)
    about = held.select(F.col("vec_id").alias("node"), "type", "name", F.substring("summary", 1, 200).alias("summary"), F.col("file_path").alias("file"))
    return hits.join(about, F.col("vec_id") == F.col("node")).select("query_id", "place", F.col("vec_id").alias("entity_id"), "type", "name", "summary", "file", F.round(1 - F.col("distance"), 6).alias("score"))


_PATH_SQL = "source || '/' || doc_id || '.md'"


@query(
    f"SELECT doc_id, sum(length) OVER (ORDER BY run, path) - length AS \"offset\", length, run::VARCHAR AS run FROM (SELECT *, strlen(block) + CASE WHEN row_number() OVER (ORDER BY run, path) = 1 THEN 0 ELSE 84 END AS length FROM"
    f" (SELECT doc_id, doc_id % 2 AS run, {_PATH_SQL} AS path, '# SOURCE: ' || {_PATH_SQL} || chr(10) || '# TIMESTAMP: now' || chr(10) || '# FORMAT: .md' || chr(10) || '---' || chr(10) || coalesce(text, '') AS block FROM documents))"
)
def consolidate_runs(spark, sf_dir):
    """Where each document lies, in bytes, in the file that two runs have appended to."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.col("source"), F.lit("/"), F.col("doc_id"), F.lit(".md")).alias("path"), F.lit(".md").alias("suffix"), F.col("text").alias("markdown"))
    store = Store(spark, f"{shared_dir(spark)}/runs-{uuid.uuid4().hex}")
    for run in (0, 1):
        consolidated.append(store, docs.where(F.col("doc_id") % 2 == run), str(run), F.lit("now"))
    rows = Staged(consolidated.blocks(store).select("run", "path", "offset", "length"), "runs").df
    store.drop(consolidated.NAME)
    return docs.select("doc_id", "path").join(rows, "path").select("doc_id", "offset", "length", "run")


@query(
    "SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN '' ELSE 'A: ' || coalesce(lang, '') || CASE WHEN doc_id % 4 = 1 THEN '' ELSE '|C: ' || coalesce(source, '') END END AS options, 'n_chars=' || n_chars AS fields FROM documents"
)
def mcq_fields(spark, sf_dir):
    """Options A to D of an item apart from its middle fields."""
    k, text = F.col("doc_id") % 4, lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    base = F.create_map(F.lit("_id"), F.col("doc_id").cast("string"), F.lit("n_chars"), text("n_chars"))
    a, c = F.create_map(F.lit("A"), text("lang")), F.create_map(F.lit("C"), text("source"))
    more = F.when(k == 0, base).when(k == 1, F.map_concat(base, a)).otherwise(F.map_concat(c, base, a))
    shown = F.array_join(F.transform(reviews.options(F.col("more")), lambda o: F.concat(o["key"], F.lit(": "), o["text"])), "|")
    fields = F.array_join(F.transform(F.map_entries(reviews.middle_fields(F.col("more"))), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "|")
    return table(spark, sf_dir, "documents").select("doc_id", more.alias("more")).select("doc_id", shown.alias("options"), fields.alias("fields"))
