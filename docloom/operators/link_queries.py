"""Queries over summary points, links and walks along them, vector hits and stored chunks.

A document's first three sentences stand in for its summary points. Verdicts on them are made from its id: point i leads
to the next document of the source where (doc_id + i) % 3 is not 0, for the first 1 + doc_id % 5 points, and follows the
one before where (doc_id + i) % 4 is not 0, for the first two; of every eleventh id the next link dangles.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docloom.functions.text import ellipsis
from docloom.operators import agents, points
from docloom.operators.adjacency import neighbours, positions
from docloom.operators.markdown_queries import ORACLE_SQL, QUERIES
from docloom.operators.queries import CHUNKS_SQL, GLOBAL_SQL, query, vector_knn
from docloom.operators.vectors import nearest
from docloom.session import Staged, table
from docloom.sources import sinks

__all__ = ["ORACLE_SQL", "QUERIES"]

DANGLING = 1_000_000_000_000
POINTS_SQL = f"""
SELECT doc_id, source, lang, i, p[i] AS point, CASE WHEN nl THEN target END AS next_id, CASE WHEN nl THEN CASE WHEN (doc_id + i) % 2 = 0 THEN 'leads into' ELSE '' END END AS next_relation, CASE WHEN nl THEN coalesce(lang, '') END AS next_topic,
    CASE WHEN pl THEN pv END AS prev_id, CASE WHEN pl THEN 'follows' END AS prev_relation, CASE WHEN pl THEN 'topic ' || i END AS prev_topic
FROM (SELECT *, target IS NOT NULL AND (doc_id + i) % 3 <> 0 AND i <= 1 + doc_id % 5 AS nl, pv IS NOT NULL AND (doc_id + i) % 4 <> 0 AND i <= 2 AS pl
    FROM (SELECT doc_id, source, lang, CASE WHEN doc_id % 11 = 0 THEN nx + {DANGLING} ELSE nx END AS target, pv, p FROM (SELECT doc_id, source, lang, lead(doc_id) OVER w AS nx, lag(doc_id) OVER w AS pv, string_split(coalesce(text, ''), '. ') AS p FROM documents WINDOW w AS (PARTITION BY source ORDER BY doc_id))), unnest([1, 2, 3]) u(i) WHERE i <= len(p))"""
#: The first link of each side by chunk; every chunk has a point.
LINKS_SQL = f"""
SELECT doc_id, any_value(source) AS source, count(*) AS n_points, min(next_id) AS next_id, arg_min(next_relation, i) FILTER (next_id IS NOT NULL) AS next_relation, arg_min(next_topic, i) FILTER (next_id IS NOT NULL) AS next_topic,
    min(prev_id) AS prev_id, arg_min(prev_relation, i) FILTER (prev_id IS NOT NULL) AS prev_relation, arg_min(prev_topic, i) FILTER (prev_id IS NOT NULL) AS prev_topic FROM ({POINTS_SQL}) GROUP BY doc_id"""


def with_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents (id, text, source, lang) with points linked to the documents around them in their source."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    near = neighbours(docs.select("doc_id", "source"), ["source"], "doc_id").select("doc_id", "previous_id", F.when(F.col("doc_id") % 11 == 0, F.col("next_id") + DANGLING).otherwise(F.col("next_id")).alias("next_id"))
    i_of = lambda i: F.col("doc_id") + i
    verdict = lambda relates, relation, topic: F.struct(relates.alias("relates"), relation.alias("relation"), topic.alias("common_topic"))
    ahead = F.transform(F.sequence(F.lit(1), (F.lit(1) + F.col("doc_id") % 5).cast("int")), lambda i: verdict(i_of(i) % 3 != 0, F.when(i_of(i) % 2 == 0, "leads into"), F.col("lang")))
    back = F.transform(F.sequence(F.lit(1), F.lit(2)), lambda i: verdict(i_of(i) % 4 != 0, F.lit("follows"), F.concat(F.lit("topic "), i.cast("string"))))
    made = points.points(F.slice(F.split(F.coalesce("text", F.lit("")), r"\. "), 1, 3))
    made = points.set_links(points.set_links(made, "next_link", ahead, F.col("next_id"), F.lit(None).cast("long")), "prev_link", back, F.col("previous_id"), F.lit(None).cast("long"))
    return docs.join(near, "doc_id").select("doc_id", "text", "source", "lang", made.alias("points"))


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, source and the first link of each side with its relation and topic."""
    rows = with_points(spark, sf_dir).select("doc_id", "source", points.first_link(F.col("points"), "next_link").alias("n"), points.first_link(F.col("points"), "prev_link").alias("p"))
    side = lambda c, name: [F.col(f"{c}.chunk_id").alias(f"{name}_id"), F.col(f"{c}.relation").alias(f"{name}_relation"), F.col(f"{c}.common_topic").alias(f"{name}_topic")]
    return rows.select("doc_id", "source", *side("n", "next"), *side("p", "prev"))


@query(f"SELECT doc_id, i::BIGINT AS place, point, next_id, next_relation, next_topic, prev_id, prev_relation, prev_topic FROM ({POINTS_SQL})")
def link_zip(spark, sf_dir):
    """Points with the verdicts at the same places."""
    rows = with_points(spark, sf_dir).select("doc_id", F.posexplode("points").alias("i", "p"))
    side = lambda c, name: [F.col(f"p.{c}.chunk_id").alias(f"{name}_id"), F.col(f"p.{c}.relation").alias(f"{name}_relation"), F.col(f"p.{c}.common_topic").alias(f"{name}_topic")]
    return rows.select("doc_id", (F.col("i") + 1).cast("long").alias("place"), F.col("p.text").alias("point"), *side("next_link", "next"), *side("prev_link", "prev"))


@query(f"SELECT doc_id, coalesce(string_agg(DISTINCT next_topic, '|'), '') AS next_topics, coalesce(string_agg(DISTINCT prev_topic, '|' ORDER BY prev_topic), '') AS prev_topics FROM ({POINTS_SQL}) GROUP BY doc_id")
def chunk_topics(spark, sf_dir):
    joined = lambda side: F.array_join(points.topics(F.col("points"), f"{side}_link"), "|").alias(f"{side}_topics")
    return with_points(spark, sf_dir).select("doc_id", joined("next"), joined("prev"))


@query(f"SELECT doc_id, count(*) AS n_points FROM ({POINTS_SQL}) GROUP BY doc_id HAVING count(*) > 0")
def chunks_with_summaries(spark, sf_dir):
    return with_points(spark, sf_dir).where(F.size("points") > 0).select("doc_id", F.size("points").cast("long").alias("n_points"))


@query(
    f"WITH l AS (SELECT doc_id, string_agg(i || '. ' || point || chr(10) || CASE WHEN prev_id IS NOT NULL THEN '   (Context from previous: ' || prev_relation || ' regarding ' || prev_topic || ')' || chr(10) ELSE '' END"
    f" || CASE WHEN next_id IS NOT NULL THEN '   (Leads to: ' || next_relation || ' regarding ' || next_topic || ')' || chr(10) ELSE '' END, '' ORDER BY i) AS listed FROM ({POINTS_SQL}) GROUP BY doc_id)"
    " SELECT doc_id, sha256(coalesce(text, '') || repeat(chr(10), 3) || 'Key Points:' || chr(10) || listed) AS text_sha256 FROM l JOIN documents USING (doc_id)"
)
def summary_text(spark, sf_dir):
    """Digests of the texts that are embedded."""
    return with_points(spark, sf_dir).select("doc_id", F.sha2(points.embedding_text(F.col("text"), F.col("points")), 256).alias("text_sha256"))


@query("SELECT doc_id, list_aggregate(list_filter(list_transform(string_split(coalesce(text, ''), '. '), lambda s: trim(s, ' ' || chr(10) || chr(9) || chr(13))), lambda s: s <> '')[1:3], 'string_agg', '|') AS summary FROM documents")
def summaries(spark, sf_dir):
    """Summaries of all documents by the offline model."""
    said = points.summarise(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", points.lead_sentences)
    return said.select("doc_id", F.when(F.size("summary") > 0, F.array_join("summary", "|")).alias("summary"))


@query(f"SELECT doc_id, source FROM ({POINTS_SQL}) GROUP BY ALL HAVING count(next_id) + count(prev_id) > 0")
def linked_chunks(spark, sf_dir):
    """Chunks of which any point has a link to either side."""
    return with_points(spark, sf_dir).where(F.exists("points", lambda p: p["next_link"].isNotNull() | p["prev_link"].isNotNull())).select("doc_id", "source")


@query(
    "SELECT count(*) AS total, count_if(n_points > 0)::BIGINT AS with_summaries, printf('%.1f%%', count_if(n_points > 0) * 100.0 / nullif(count(*), 0)) AS summarised_share, sum(n_points)::BIGINT AS total_points, round(sum(n_points) / nullif(count_if(n_points > 0), 0), 2) AS points_per_chunk,"
    f" count(next_id) AS next_linked, count(prev_id) AS prev_linked, count_if(next_id IS NOT NULL OR prev_id IS NOT NULL)::BIGINT AS linked, round(count_if(next_id IS NOT NULL OR prev_id IS NOT NULL) / nullif(count(*), 0), 4) AS linked_ratio FROM ({LINKS_SQL})"
)
def chunk_stats(spark, sf_dir):
    """One row about the collection; shares of an empty one are null."""
    n, has = F.size("points"), lambda side: F.exists("points", lambda p: p[f"{side}_link"].isNotNull())
    rows = with_points(spark, sf_dir).select(n.alias("n"), has("next").alias("next"), has("prev").alias("prev"))
    some, either = F.count_if(F.col("n") > 0), F.count_if(F.col("next") | F.col("prev"))
    return rows.agg(
        F.count("*").alias("total"), some.alias("with_summaries"), F.format_string("%.1f%%", F.try_divide(some * 100.0, F.count("*"))).alias("summarised_share"), F.sum("n").alias("total_points"), F.round(F.try_divide(F.sum("n"), some), 2).alias("points_per_chunk"),
        F.count_if("next").alias("next_linked"), F.count_if("prev").alias("prev_linked"), either.alias("linked"), F.round(F.try_divide(either, F.count("*")), 4).alias("linked_ratio"),
    )


@query(
    f"SELECT l.doc_id, l.next_id, d.source AS next_source, substr(d.text, 1, 500) AS content, next_relation AS relation, next_topic AS topic, CASE WHEN l.next_id IS NULL THEN 'no link' WHEN d.doc_id IS NULL THEN 'missing target' ELSE 'ok' END AS status FROM ({LINKS_SQL}) l LEFT JOIN documents d ON d.doc_id = l.next_id"
)
def follow_link(spark, sf_dir):
    """The chunk that the first link ahead leads to, with the link's relation and topic."""
    target = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("target"), F.col("source").alias("next_source"), F.substring("text", 1, 500).alias("content"))
    found = links(spark, sf_dir).join(target, F.col("next_id") == F.col("target"), "left")
    status = F.when(F.col("next_id").isNull(), "no link").when(F.col("target").isNull(), "missing target").otherwise("ok")
    return found.select("doc_id", "next_id", "next_source", "content", F.col("next_relation").alias("relation"), F.col("next_topic").alias("topic"), status.alias("status"))


def walk(linked: DataFrame, column: str, hops: int) -> DataFrame:
    """start_id, hop from 0, doc_id: along links as far as they lead to a row, one join a hop. All hops join the same
    rows on the same key, so the links are shuffled once."""
    step = linked.select(F.col("doc_id").alias("at"), F.col(column).alias("to"))
    now = linked.select(F.col("doc_id").alias("start_id"), F.lit(0).alias("hop"), "doc_id", F.col(column).alias("to"))
    out = now
    for hop in range(1, hops + 1):
        now = now.select("start_id", F.col("to").alias("doc_id")).where("doc_id is not null").join(step, F.col("doc_id") == F.col("at")).select("start_id", F.lit(hop).alias("hop"), "doc_id", "to")
        out = out.unionByName(now)
    return out.drop("to")


def chain(linked: DataFrame, column: str, hops: int, name: str) -> DataFrame:
    """start_id and the ids on its chain, the nearest first: one join a hop, in which chains that have ended keep what they have."""
    step = linked.select(F.col("doc_id").alias("at"), F.col(column).alias("to"))
    now = linked.select(F.col("doc_id").alias("start_id"), F.array().cast("array<bigint>").alias(name), F.col(column).alias("next"))
    for _ in range(hops):
        found = now.join(step, F.col("next") == F.col("at"), "left")
        now = found.select("start_id", F.when(F.col("at").isNotNull(), F.array_append(name, F.col("at"))).otherwise(F.col(name)).alias(name), F.col("to").alias("next"))
    return now.select("start_id", name)


def staged_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Staged(links(spark, sf_dir).select("doc_id", "next_id", "prev_id"), "links").df


def _walk_sql(column: str, hops: int) -> str:
    return f"SELECT doc_id AS start_id, doc_id, 0 AS hop FROM l UNION ALL SELECT w.start_id, t.doc_id, w.hop + 1 FROM w JOIN l ON l.doc_id = w.doc_id JOIN l t ON t.doc_id = l.{column} WHERE w.hop < {hops}"


WALKS_SQL = f"WITH RECURSIVE l AS MATERIALIZED ({LINKS_SQL}), n AS ({_walk_sql('next_id', 5).replace(' w ', ' n ').replace('w.', 'n.')}), p AS ({_walk_sql('prev_id', 2).replace(' w ', ' p ').replace('w.', 'p.')})"


@query(f"WITH RECURSIVE l AS MATERIALIZED ({LINKS_SQL}), w AS ({_walk_sql('next_id', 3)}) SELECT start_id, hop, doc_id FROM w")
def link_chain(spark, sf_dir):
    """Up to three hops along next links; a chain ends where there is no link or its target is missing."""
    return walk(staged_links(spark, sf_dir), "next_id", 3)


MOVES_SQL = "SELECT doc_id AS start_id, turn, CASE WHEN (doc_id + turn * turn) % 3 = 0 THEN 'prev' ELSE 'next' END AS direction FROM documents, range(1, 21) t(turn)"


@query(
    f"{WALKS_SQL}, m AS (SELECT *, row_number() OVER (PARTITION BY start_id, direction ORDER BY turn) AS hop FROM ({MOVES_SQL}) WHERE turn <= 15),"
    " r AS (SELECT m.start_id, m.turn, c.doc_id FROM m JOIN (SELECT *, 'next' AS direction FROM n UNION ALL SELECT *, 'prev' FROM p) c ON c.start_id = m.start_id AND c.direction = m.direction AND c.hop = m.hop AND c.hop > 0)"
    " SELECT d.doc_id AS start_id, concat_ws(',', d.doc_id::VARCHAR, string_agg(r.doc_id::VARCHAR, ',' ORDER BY turn)) AS visited FROM documents d LEFT JOIN r ON r.start_id = d.doc_id GROUP BY d.doc_id"
)
def bounded_walk(spark, sf_dir):
    """At most five links ahead and two back within fifteen moves, and the chunks in the order they were reached."""
    linked = staged_links(spark, sf_dir)
    chains = chain(linked, "next_id", 5, "ahead").join(chain(linked, "prev_id", 2, "back"), "start_id")
    moves = F.transform(F.sequence(F.lit(1), F.lit(20)), lambda turn: F.when((F.col("start_id") + turn * turn) % 3 == 0, "prev").otherwise("next"))
    return chains.select("start_id", F.array_join(agents.guided_walk(F.col("start_id"), moves, F.col("ahead"), F.col("back")).cast("array<string>"), ",").alias("visited"))


def _link(side: str) -> Column:
    return points.first_link(F.col("points"), f"{side}_link")


@query(
    f"SELECT l.doc_id, substr(d.text, 1, 500) AS content, (SELECT string_agg(point, '|' ORDER BY i) FROM ({POINTS_SQL}) p WHERE p.doc_id = l.doc_id AND i <= 2) AS summary, next_id, next_relation, next_topic, prev_id, prev_relation, prev_topic FROM ({LINKS_SQL}) l JOIN documents d ON d.doc_id = l.doc_id"
)
def search_projection(spark, sf_dir):
    """What a search shows of a chunk: its head, two points and the first link of each side."""
    side = lambda name: [_link(name)["chunk_id"].alias(f"{name}_id"), _link(name)["relation"].alias(f"{name}_relation"), _link(name)["common_topic"].alias(f"{name}_topic")]
    return with_points(spark, sf_dir).select("doc_id", F.substring("text", 1, 500).alias("content"), F.array_join(F.transform(F.slice("points", 1, 2), lambda p: p["text"]), "|").alias("summary"), *side("next"), *side("prev"))


@query(f"SELECT k.query_id, k.vec_id, k.place, s.* EXCLUDE (doc_id) FROM ({ORACLE_SQL['vector_knn']}) k JOIN ({ORACLE_SQL['search_projection']}) s ON s.doc_id = k.vec_id")
def doc_search(spark, sf_dir):
    """Nearest vectors with what a search shows of their documents."""
    shown = search_projection(spark, sf_dir)
    return vector_knn(spark, sf_dir).join(shown, F.col("vec_id") == F.col("doc_id")).drop("doc_id", "distance")


NODE_SQL = "SELECT vec_id, CASE label % 3 WHEN 0 THEN 'function' WHEN 1 THEN 'class' ELSE 'file' END AS type, 'node_' || vec_id AS name, repeat('about ' || label || ' ', 40) AS summary, 'src/' || label || '.py' AS file, CASE WHEN vec_id % 17 = 3 THEN NULL ELSE embedding END AS embedding FROM embeddings"
COSINE_SQL = "list_dot_product(a::DOUBLE[], embedding::DOUBLE[]) / sqrt(list_dot_product(a::DOUBLE[], a::DOUBLE[]) * list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]))"


@query(
    f"WITH n AS ({NODE_SQL}), q AS (SELECT vec_id AS query_id, embedding AS a FROM embeddings WHERE vec_id % 20 = 0), s AS (SELECT query_id, vec_id, type, name, summary, file, round(1 - {COSINE_SQL}, 6) AS d FROM q, n WHERE embedding IS NOT NULL),"
    " r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY d, vec_id) AS place FROM s) SELECT query_id, place, vec_id AS entity_id, type, name, substr(summary, 1, 200) AS summary, file, round(1 - d, 6) AS score FROM r WHERE place <= 5"
)
def code_search(spark, sf_dir):
    """Code nodes by falling similarity; nodes without a vector are left out."""
    rows, label = table(spark, sf_dir, "embeddings"), F.col("label").cast("string")
    kind = F.when(F.col("label") % 3 == 0, "function").when(F.col("label") % 3 == 1, "class").otherwise("file")
    nodes = rows.select("vec_id", kind.alias("type"), F.concat(F.lit("node_"), "vec_id").alias("name"), F.repeat(F.concat(F.lit("about "), label, F.lit(" ")), F.lit(40)).alias("summary"), F.concat(F.lit("src/"), label, F.lit(".py")).alias("file"), F.when(F.col("vec_id") % 17 != 3, F.col("embedding")).alias("embedding"))
    hits = nearest(rows.where("vec_id % 20 = 0").select("vec_id", "embedding"), nodes.select("vec_id", "embedding"), 5)
    about = nodes.select(F.col("vec_id").alias("entity_id"), "type", "name", F.substring("summary", 1, 200).alias("summary"), "file")
    return hits.join(about, F.col("vec_id") == F.col("entity_id")).select("query_id", "place", "entity_id", "type", "name", "summary", "file", F.round(1 - F.col("distance"), 6).alias("score"))


#: The offline embedder: the digits of a digest.
DIGITS = 16
EMBED_SQL = f"list_transform(range(1, {DIGITS + 1}), lambda k: ('0x' || substr(md5(coalesce(text, '')), k::INT, 1))::INT)"


def digest_vectors(texts: list[str]) -> list[list[float]]:
    return [[float(int(c, 16)) for c in hashlib.md5(t.encode()).hexdigest()[:DIGITS]] for t in texts]


@query(f"SELECT doc_id, list_aggregate({EMBED_SQL}, 'string_agg', ',') AS embedding FROM documents")
def embed_batch(spark, sf_dir):
    """All documents embedded in batches by the offline embedder."""
    made = points.embed(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", digest_vectors)
    return made.select("doc_id", F.array_join(F.col("embedding").cast("array<int>").cast("array<string>"), ",").alias("embedding"))


@query(
    f"WITH q AS (SELECT item_id AS query_id, {EMBED_SQL} AS a FROM benchmark WHERE item_id % 20 = 0), d AS (SELECT doc_id, {EMBED_SQL} AS embedding FROM documents), s AS (SELECT query_id, doc_id, round(1 - {COSINE_SQL}, 6) AS distance FROM q, d),"
    " r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, doc_id) AS place FROM s) SELECT query_id, doc_id, place, distance FROM r WHERE place <= 5"
)
def text_query(spark, sf_dir):
    """Texts as queries, embedded by the embedder of the documents."""
    vectors = lambda name, key: points.embed(table(spark, sf_dir, name).select(F.col(key).alias("vec_id"), "text"), "text", digest_vectors).select("vec_id", "embedding")
    return nearest(vectors("benchmark", "item_id").where("vec_id % 20 = 0"), vectors("documents", "doc_id"), 5).withColumnRenamed("vec_id", "doc_id")


@query(
    f"SELECT g.doc_id, to_json({{'current_chunk_id': g.doc_id, 'has_previous': previous_id IS NOT NULL, 'has_next': g.next_id IS NOT NULL, 'summary_points_links': list({{'point': substr(point, 1, 100), 'connects_previous': p.prev_id IS NOT NULL, 'connects_next': p.next_id IS NOT NULL, 'prev_relation': coalesce(prev_relation, ''), 'next_relation': coalesce(next_relation, '')}} ORDER BY i)}})::VARCHAR AS info"
    f" FROM ({GLOBAL_SQL}) g JOIN ({POINTS_SQL}) p ON p.doc_id = g.doc_id GROUP BY g.doc_id, previous_id, g.next_id"
)
def navigation_info(spark, sf_dir):
    """What an agent is told of a chunk's place and of the links of its points, as JSON."""
    held = lambda p, side: p[f"{side}_link"]
    about = lambda p: F.struct(F.substring(p["text"], 1, 100).alias("point"), held(p, "prev").isNotNull().alias("connects_previous"), held(p, "next").isNotNull().alias("connects_next"), F.coalesce(held(p, "prev")["relation"], F.lit("")).alias("prev_relation"), F.coalesce(held(p, "next")["relation"], F.lit("")).alias("next_relation"))
    told = with_points(spark, sf_dir).select("doc_id", F.transform("points", about).alias("told"))
    near = neighbours(table(spark, sf_dir, "documents").select("doc_id"), [], "doc_id").join(told, "doc_id")
    info = F.struct(F.col("doc_id").alias("current_chunk_id"), F.col("previous_id").isNotNull().alias("has_previous"), F.col("next_id").isNotNull().alias("has_next"), F.col("told").alias("summary_points_links"))
    return near.select("doc_id", F.to_json(info, {"ignoreNullFields": "false"}).alias("info"))


#: Questions about every chunk, some with words that ask for a side.
QUESTION_SQL = "CASE doc_id % 4 WHEN 0 THEN 'What came BEFORE this?' WHEN 1 THEN 'Explain the following step' WHEN 2 THEN 'continue' ELSE 'In what Context, and what is next?' END"


def question_of() -> Column:
    k = F.col("doc_id") % 4
    return F.when(k == 0, "What came BEFORE this?").when(k == 1, "Explain the following step").when(k == 2, "continue").otherwise("In what Context, and what is next?")


NEED_SQL = f"SELECT doc_id, q, next_id IS NOT NULL OR regexp_matches(lower(q), 'next|following|after') AS wants_next, prev_id IS NOT NULL OR regexp_matches(lower(q), 'previous|before|context') AS wants_previous FROM (SELECT *, {QUESTION_SQL} AS q FROM ({LINKS_SQL}))"


@query(f"SELECT doc_id, wants_previous, wants_next FROM ({NEED_SQL})")
def adjacency_need(spark, sf_dir):
    """Whether a question about a chunk needs the chunk before or after it, by its words or the chunk's links."""
    need = agents.adjacency_need(question_of(), F.col("points"))
    return with_points(spark, sf_dir).select("doc_id", need.alias("need")).select("doc_id", F.col("need.previous").alias("wants_previous"), F.col("need.next").alias("wants_next"))


@query(
    f"SELECT g.doc_id, 'Question: ' || n.q || repeat(chr(10), 2) || 'Current Chunk (ID: ' || g.doc_id || '):' || chr(10) || substr(d.text, 1, 1500) || repeat(chr(10), 2)"
    " || CASE WHEN wants_previous AND a.doc_id IS NOT NULL THEN 'Previous Chunk Context (ID: ' || a.doc_id || '):' || chr(10) || substr(a.text, 1, 1000) || repeat(chr(10), 2) ELSE '' END"
    " || CASE WHEN wants_next AND b.doc_id IS NOT NULL THEN 'Next Chunk Context (ID: ' || b.doc_id || '):' || chr(10) || substr(b.text, 1, 1000) || repeat(chr(10), 2) ELSE '' END AS context"
    f" FROM ({GLOBAL_SQL}) g JOIN documents d ON d.doc_id = g.doc_id JOIN ({NEED_SQL}) n ON n.doc_id = g.doc_id LEFT JOIN documents a ON a.doc_id = g.previous_id LEFT JOIN documents b ON b.doc_id = g.next_id"
)
def answer_context(spark, sf_dir):
    """The text an answer starts from, with the neighbours that it needs; only the heads of texts are shuffled."""
    heads = with_points(spark, sf_dir).select("doc_id", F.substring("text", 1, 1500).alias("head"), agents.adjacency_need(question_of(), F.col("points")).alias("need"))
    heads = Staged(heads, "heads").df
    side = lambda name: heads.select(F.struct(F.col("doc_id").alias("id"), F.substring("head", 1, 1000).alias("content")).alias(f"{name}_side"), F.col("doc_id").alias(name))
    near = neighbours(heads.select("doc_id"), [], "doc_id").join(heads, "doc_id").join(side("previous_id"), "previous_id", "left").join(side("next_id"), "next_id", "left")
    context = agents.answer_context(question_of(), F.col("doc_id"), F.col("head"), F.col("need"), F.col("previous_id_side"), F.col("next_id_side"))
    return near.select("doc_id", context.alias("context"))


@query(
    f"SELECT l.doc_id, chr(10) || chr(10) || 'RECENTLY VIEWED CHUNKS:' || chr(10) || string_agg(chr(10) || 'Chunk ' || c.doc_id || ':' || chr(10) || 'Summary: [' || summary || ']' || chr(10) || 'Content preview: ' || substr(c.text, 1, 300) || '...' || chr(10), '' ORDER BY c.doc_id) AS context"
    f" FROM ({LINKS_SQL}) l JOIN (SELECT d.doc_id, any_value(text) AS text, string_agg('''' || point || '''', ', ' ORDER BY i) FILTER (i <= 2) AS summary FROM documents d JOIN ({POINTS_SQL}) p ON p.doc_id = d.doc_id GROUP BY d.doc_id) c ON c.doc_id IN (l.doc_id, l.next_id) GROUP BY l.doc_id"
)
def recent_context(spark, sf_dir):
    """What an agent is shown of a chunk and the one its link leads to."""
    seen = with_points(spark, sf_dir).select("doc_id", F.struct(F.col("doc_id").alias("id"), F.transform(F.slice("points", 1, 2), lambda p: p["text"]).alias("summary"), F.substring("text", 1, 300).alias("content")).alias("chunk"))
    linked = links(spark, sf_dir).select(F.col("doc_id").alias("at"), "next_id")
    pairs = linked.join(seen, F.col("at") == F.col("doc_id")).drop("doc_id").withColumnRenamed("chunk", "own").join(seen, F.col("next_id") == F.col("doc_id"), "left")
    return pairs.select(F.col("at").alias("doc_id"), agents.recent_context(F.array_compact(F.array("own", "chunk"))).alias("context"))


STORED_SQL = (
    "SELECT c.doc_id, c.source AS source_file, c.chunk_index::VARCHAR AS chunk_index, '0' AS start_char, c.n_chars::VARCHAR AS end_char, to_json([lang])::VARCHAR AS headers, points AS summary_points"
    f" FROM ({CHUNKS_SQL}) c JOIN (SELECT doc_id, any_value(lang) AS lang, to_json(list({{'text': point, 'prev_link': CASE WHEN prev_id IS NOT NULL THEN {{'chunk_id': prev_id, 'chunk_index': NULL, 'relation': prev_relation, 'common_topic': prev_topic}} END,"
    f" 'next_link': CASE WHEN next_id IS NOT NULL THEN {{'chunk_id': next_id, 'chunk_index': NULL, 'relation': next_relation, 'common_topic': next_topic}} END}} ORDER BY i))::VARCHAR AS points FROM ({POINTS_SQL}) GROUP BY doc_id) p ON p.doc_id = c.doc_id"
)


def stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as the chunk store has them: flat columns, numbers as text, lists as JSON."""
    docs = positions(table(spark, sf_dir, "documents").select("doc_id", "n_chars", "source"), ["source"], "doc_id").join(with_points(spark, sf_dir).select("doc_id", "lang", "points"), "doc_id")
    return docs.select("doc_id", *sinks.metadata(F.col("source"), F.col("chunk_index"), F.lit(0), F.col("n_chars"), F.array("lang"), F.col("points")))


@query(STORED_SQL)
def chunk_metadata(spark, sf_dir):
    """The flat columns of the chunk store, points and headers as JSON."""
    return stored(spark, sf_dir)


@query(
    f"SELECT doc_id, chunk_index::BIGINT AS chunk_index, source_file, end_char::BIGINT AS end_char, list_aggregate(from_json(headers, '[\"VARCHAR\"]'), 'string_agg', ' > ') AS headers, json_array_length(summary_points)::BIGINT AS n_points, json_extract_string(summary_points, '$[0].text') AS first_point FROM ({STORED_SQL})"
)
def load_chunks(spark, sf_dir):
    """The store read back, JSON decoded, in the order of chunk numbers."""
    rows = sinks.decoded(stored(spark, sf_dir)).orderBy("chunk_index", "doc_id")
    return rows.select("doc_id", "chunk_index", "source_file", "end_char", F.nullif(F.array_join("headers", " > "), F.lit("")).alias("headers"), F.size("summary_points").cast("long").alias("n_points"), F.get("summary_points", F.lit(0))["text"].alias("first_point"))


@query("SELECT source, count(*) AS n, row_number() OVER (ORDER BY min(doc_id)) AS place FROM documents GROUP BY source QUALIFY place <= 5")
def first_sources(spark, sf_dir):
    """The five sources seen first, in that order, with their chunks."""
    top = table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n"), F.min("doc_id").alias("first")).orderBy("first").limit(5)
    return top.select("source", "n", F.row_number().over(Window.orderBy("first")).cast("long").alias("place"))


@query(f"SELECT doc_id, 'Chunk Index: ' || chunk_index || chr(10) || 'Source File: ' || source || chr(10) || 'Content Preview (' || n_chars || ' chars):' || chr(10) || CASE WHEN length(text) > 300 THEN substr(text, 1, 300) || '...' ELSE text END AS shown FROM ({CHUNKS_SQL})")
def chunk_print(spark, sf_dir):
    """A chunk as the reader prints it."""
    heads = table(spark, sf_dir, "documents").select("doc_id", "source", ellipsis(F.col("text"), 300).alias("head"), "n_chars")
    placed = positions(heads, ["source"], "doc_id")
    lines = [F.concat(F.lit("Chunk Index: "), F.col("chunk_index").cast("string")), F.concat(F.lit("Source File: "), "source"), F.concat(F.lit("Content Preview ("), F.col("n_chars").cast("string"), F.lit(" chars):")), "head"]
    return placed.select("doc_id", F.concat_ws("\n", *lines).alias("shown"))
