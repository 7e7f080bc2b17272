"""Queries over messages, questions, answers, definitions, updates and pages of a review.

``conversations`` are message traces: the assistant calls (conv_id + turn) % 3 tools a message, and what follows in even
conversations is the tool's result. What no table holds is made by hand, the same in Spark and in SQL.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions import json_text
from docloom.operators import agents
from docloom.operators.adjacency import positions
from docloom.operators.link_queries import ORACLE_SQL, QUERIES
from docloom.operators.queries import SCORES_SQL, query, scores
from docloom.session import table
from docloom.sources.converters import html_table
from docloom.sources.sheets import pipe_table
from docloom.sources.sinks import json_line

__all__ = ["ORACLE_SQL", "QUERIES"]


def _values(rows: list[tuple], names: str) -> str:
    shown = lambda v: "NULL" if v is None else "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)
    return f"(VALUES {', '.join('(' + ', '.join(map(shown, r)) + ')' for r in rows)}) t({names})"


TOOLS = ("search_documentation", "get_linked_chunk")
MESSAGES_SQL = "SELECT conv_id, turn, CASE WHEN role = 'system' THEN 'system' WHEN role = 'assistant' THEN 'ai' WHEN turn > 1 AND conv_id % 2 = 0 THEN 'tool' ELSE 'human' END AS role, CASE WHEN role = 'assistant' AND turn % 4 = 1 THEN '' ELSE text END AS content, CASE WHEN role = 'assistant' THEN (conv_id + turn) % 3 ELSE 0 END AS n_calls FROM conversations"
CALL_SQL = f"CASE k WHEN 0 THEN '{TOOLS[0]}' ELSE '{TOOLS[1]}' END"
STEPS_SQL = (
    f"SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, k) AS step_number, CASE WHEN content = '' THEN '{agents.DEFAULT_THOUGHT}' ELSE content END AS thought, {CALL_SQL} AS action, '{{\"turn\":' || turn || '}}' AS action_input,"
    " CASE WHEN next_role = 'tool' THEN CASE WHEN length(next_content) > 500 THEN left(next_content, 500) || '...' ELSE next_content END ELSE '' END AS observation"
    f" FROM (SELECT *, lead(role) OVER w AS next_role, lead(content) OVER w AS next_content FROM ({MESSAGES_SQL}) WINDOW w AS (PARTITION BY conv_id ORDER BY turn)), range(0, 2) c(k) WHERE role = 'ai' AND k < n_calls"
)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = table(spark, sf_dir, "conversations")
    ai = F.col("role") == "assistant"
    role = F.when(F.col("role") == "system", "system").when(ai, "ai").when((F.col("turn") > 1) & (F.col("conv_id") % 2 == 0), "tool").otherwise("human")
    args = F.concat(F.lit('{"turn":'), F.col("turn").cast("string"), F.lit("}"))
    calls = F.slice(F.array(*[F.struct(F.lit(t).alias("name"), args.alias("args")) for t in TOOLS]), F.lit(1), F.when(ai, (F.col("conv_id") + F.col("turn")) % 3).otherwise(0).cast("int"))
    return said.select("conv_id", "turn", role.alias("role"), F.when(ai & (F.col("turn") % 4 == 1), "").otherwise(F.col("text")).alias("content"), calls.alias("calls"))


@query(STEPS_SQL)
def reasoning_steps(spark, sf_dir):
    """One step a tool call, with what came back."""
    return agents.reasoning_steps(messages(spark, sf_dir), "conv_id", "turn")


@query(f"SELECT conv_id, string_agg('<|step|>' || step_number || '<|end_step|>' || chr(10) || '<|thought|>' || thought || '<|end_thought|>' || chr(10) || '<|action|>' || action || '<|end_action|>' || chr(10) || '<|observation|>' || observation || '<|end_observation|>' || chr(10), '' ORDER BY step_number) AS reasoning FROM ({STEPS_SQL}) GROUP BY conv_id")
def format_reasoning(spark, sf_dir):
    return agents.format_reasoning(reasoning_steps(spark, sf_dir), "conv_id")


@query(
    f"WITH m AS ({MESSAGES_SQL}), p AS (SELECT conv_id, turn, 0 AS k, CASE role WHEN 'human' THEN 'Q: ' || content WHEN 'tool' THEN 'TOOL RESULT: ' || CASE WHEN length(content) > 1000 THEN left(content, 1000) || '...' ELSE content END ELSE 'A: ' || content END AS said FROM m WHERE role IN ('human', 'tool') OR role = 'ai' AND content <> ''"
    f" UNION ALL SELECT conv_id, turn, k + 1, 'USED TOOL: ' || {CALL_SQL} || '({{\"turn\":' || turn || '}})' FROM m, range(0, 2) c(k) WHERE k < n_calls)"
    " SELECT conv_id, 'ORIGINAL QUESTION: ' || coalesce((SELECT arg_min(content, turn) FROM m WHERE m.conv_id = p.conv_id AND role = 'human'), '') || chr(10) || chr(10) || 'REASONING PROCESS FOLLOWED:' || chr(10) || string_agg(said, chr(10) ORDER BY turn, k) || chr(10) || chr(10) || 'BASED ON THE ABOVE REASONING, PROVIDE A COMPREHENSIVE FINAL ANSWER:' AS context FROM p GROUP BY conv_id"
)
def synthesis_context(spark, sf_dir):
    """The trace of an answer as one text for the final answer; a conversation fits a row."""
    return agents.synthesis_context(messages(spark, sf_dir), "conv_id", "turn")


JSON_TEXTS = [
    (1, '{"a": 1, "b": [1, 2]}'), (2, '["x", {"chunk_id": "c1"}]'), (3, "plain words"), (4, "12"), (5, ""), (6, None), (7, "null"), (8, '[1, 2'), (9, 'so: {"a": "b"} and more'), (10, 'list [{"chunk_id": "c2"}, {"entity_id": "e1"}] end'),
    (11, '[{"chunk_id": "c3"}, {"other": 1}, "s", {"entity_id": "e2", "x": null}]'), (12, "} no {"), (13, "[1] but } only"), (14, '```json\n{"tool": "t"}\n```'), (15, '  ```\n{"tool": {"n": 2}}\n``` tail'), (16, "true"), (17, "```no json```"), (18, '{"a": {"b": 1}} {"c": 2}'),
]


def json_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts made by hand, and the properties of all events."""
    return spark.createDataFrame(JSON_TEXTS, "id long, text string").unionByName(table(spark, sf_dir, "events").select((-1 - F.col("event_id")).alias("id"), F.col("props").alias("text")))


JSON_SQL = f"SELECT id::BIGINT AS id, text FROM {_values(JSON_TEXTS, 'id, text')} UNION ALL SELECT -1 - event_id, props FROM events"
WHOLE_SQL = "CASE WHEN json_valid(text) THEN json(text)::VARCHAR END"
LEGACY_SQL = "CASE WHEN contains(text, '{') AND contains(text, '}') THEN CASE WHEN json_valid(regexp_extract(text, '(?s)\\{.*\\}')) THEN json(regexp_extract(text, '(?s)\\{.*\\}'))::VARCHAR END WHEN contains(text, '[') AND contains(text, ']') THEN CASE WHEN json_valid(regexp_extract(text, '(?s)\\[.*\\]')) THEN json(regexp_extract(text, '(?s)\\[.*\\]'))::VARCHAR END END"


@query(f"SELECT id, json_valid(text) AND text IS NOT NULL AS is_json, coalesce({WHOLE_SQL}, text) AS value FROM ({JSON_SQL}) WHERE text IS NOT NULL")
def json_or_raw(spark, sf_dir):
    """Values that are JSON, decoded, and all others as they are."""
    rows = json_texts(spark, sf_dir).where("text is not null")
    is_json = json_text.strict_json(F.col("text")).isNotNull()
    value = json_text.json_or_raw(F.col("text"))
    return rows.select("id", is_json.alias("is_json"), F.when(is_json, F.to_json(value)).otherwise(value.cast("string")).alias("value"))


@query(f"SELECT id, coalesce({WHOLE_SQL}, {LEGACY_SQL}) AS found, {LEGACY_SQL} AS legacy FROM ({JSON_SQL})")
def extract_json(spark, sf_dir):
    """The JSON within answers, by both rules."""
    return json_texts(spark, sf_dir).select("id", F.to_json(json_text.loose_json(F.col("text"))).alias("found"), F.to_json(json_text.loose_json(F.col("text"), strict_legacy=True)).alias("legacy"))


@query(
    f"SELECT id, CASE WHEN json_valid(x) THEN json(x)::VARCHAR END AS found FROM (SELECT id, CASE WHEN starts_with(b, '```') AND regexp_matches(b, '(?s)```(?:json)?\\s*(\\{{.*?\\}})\\s*```') THEN regexp_extract(b, '(?s)```(?:json)?\\s*(\\{{.*?\\}})\\s*```', 1) ELSE b END AS x FROM (SELECT id, trim(text) AS b FROM ({JSON_SQL})))"
)
def extract_fenced_json(spark, sf_dir):
    """The JSON of answers that may stand in a code fence."""
    return json_texts(spark, sf_dir).select("id", F.to_json(json_text.fenced_json(F.col("text"))).alias("found"))


@query(
    f"SELECT DISTINCT id % 3 AS conv_id, coalesce(json_extract_string(item, '$.chunk_id'), json_extract_string(item, '$.entity_id')) AS source FROM (SELECT id, unnest(CASE WHEN json_type(found) = 'ARRAY' THEN json(found)::JSON[] END) AS item FROM (SELECT id, coalesce({WHOLE_SQL}, {LEGACY_SQL}) AS found FROM ({JSON_SQL}))) WHERE json_type(item) = 'OBJECT' AND source IS NOT NULL"
)
def extract_sources(spark, sf_dir):
    """Ids that lists in messages name, each once a conversation."""
    return agents.message_sources(json_texts(spark, sf_dir).select((F.col("id") % 3).alias("conv_id"), F.col("text").alias("content")), "conv_id")


ASKED_SQL = (
    "SELECT doc_id, k, len(s) AS n, 'What is said by: ' || s[k] AS question, CASE WHEN k <= 3 THEN 'easy' ELSE 'medium' END AS question_type, 'sentence ' || k AS rationale"
    " FROM (SELECT doc_id, list_filter(string_split(left(coalesce(text, ''), 2000), '. '), lambda x: x <> '')[1:10] AS s FROM documents), range(1, 11) r(k) WHERE k <= len(s)"
)
KEPT_SQL = f"SELECT doc_id, k, question, question_type, rationale, (n // 2) - (k // 2) + 1 AS place FROM ({ASKED_SQL}) WHERE k % 2 = 0 UNION ALL SELECT doc_id, k, question, question_type, rationale, (n // 2) + 1 FROM ({ASKED_SQL}) WHERE k = 1"


@query(f"SELECT doc_id AS chunk_id, place::BIGINT AS place, doc_id || '_q' || k AS question_id, question, question_type, rationale FROM ({KEPT_SQL})")
def generate_questions(spark, sf_dir):
    """Questions of the offline model, three easy ones of ten, as the offline filter keeps them."""
    return agents.generate_questions(table(spark, sf_dir, "documents"), agents.first_questions, agents.keep_long, id_col="doc_id", text_col="text")


@query(f"SELECT doc_id || '_q' || k AS question_id, k::BIGINT AS number FROM ({KEPT_SQL})")
def question_ids(spark, sf_dir):
    """Numbers given before the filter: what it leaves out leaves a gap."""
    made = generate_questions(spark, sf_dir)
    return made.select("question_id", F.element_at(F.split("question_id", "_q"), -1).cast("long").alias("number"))


KEEP = [(0, 2), (0, 1), (0, 2), (0, 9), (1, 1), (2, 0), (2, 3), (2, -1), (3, 2)]


@query(f"SELECT conv_id, place, turn FROM (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS pos FROM conversations WHERE role = 'user') JOIN (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY seq) AS place FROM {_values([(k, p, n) for n, (k, p) in enumerate(KEEP)], 'kind, pos, seq')}) k USING (pos) WHERE conv_id % 4 = kind")
def index_filter(spark, sf_dir):
    """Questions by the keep-list of each conversation, of places from 1: its order and repeats stay, places out of range go."""
    asked = positions(table(spark, sf_dir, "conversations").where("role = 'user'").select("conv_id", "turn"), ["conv_id"], "turn", "at")
    lists = F.array(*[F.array(*[F.lit(p) for k, p in KEEP if k == kind]) for kind in range(4)])
    kept = asked.select("conv_id", "turn", "at", F.posexplode(F.get(lists, (F.col("conv_id") % 4).cast("int"))).alias("k", "pos")).where("pos = at + 1")
    return kept.select("conv_id", (F.col("k") + 1).cast("long").alias("place"), "turn")


def label_judge(row: dict) -> dict:
    """The offline judge: scores from the labels; some are out of range."""
    q, t = float(row["quality"]), float(row["toxic"])
    return {"completeness": q, "accuracy": 1 - t, "relevance": q * 1.5 if row["doc_id"] % 10 == 3 else q, "clarity": 1.0, "specificity": 1 - t, "reasoning": 0.5}


JUDGED_SQL = "SELECT *, relevance <= 1 AS ok, (completeness + accuracy + relevance + clarity + specificity + reasoning) / 6 AS mean FROM (SELECT doc_id, quality::DOUBLE AS completeness, 1.0::DOUBLE - toxic AS accuracy, CASE WHEN doc_id % 10 = 3 THEN quality * 1.5::DOUBLE ELSE quality::DOUBLE END AS relevance, 1.0::DOUBLE AS clarity, 1.0::DOUBLE - toxic AS specificity, 0.5::DOUBLE AS reasoning FROM labels WHERE quality IS NOT NULL AND toxic IS NOT NULL)"


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "labels").where("quality is not null and toxic is not null").select("doc_id", "quality", "toxic")
    return agents.judged(rows, label_judge, ["doc_id", "quality", "toxic"])


@query(f"SELECT doc_id, completeness, accuracy, relevance, clarity, specificity, reasoning, CASE WHEN ok THEN round(mean, 6) END AS overall, CASE WHEN ok THEN 'ok' ELSE 'quarantined' END AS status FROM ({JUDGED_SQL})")
def judge_answers(spark, sf_dir):
    """Six scores an answer and their mean; answers with a score out of range are set apart."""
    return judged(spark, sf_dir).select("doc_id", *agents.SCORES, F.round("overall", 6).alias("overall"), "status")


@query(f"SELECT count(*) AS total, count_if(ok AND mean >= 0.7)::BIGINT AS accepted, count_if(NOT ok)::BIGINT AS quarantined FROM ({JUDGED_SQL})")
def accept_tally(spark, sf_dir):
    return judged(spark, sf_dir).agg(F.count("*").alias("total"), F.count_if(F.col("overall") >= 0.7).alias("accepted"), F.count_if(F.col("status") == "quarantined").alias("quarantined"))


SNIPPETS = [(1, 'def load(path):\n    """Reads."""', 'x'), (2, "def bare(a, b):\n    pass", "y"), (3, "no code here", "z"), (4, None, None), (5, 'class A:\n  def run(self):\n    """Runs."""', "w")]
_DEFINED = re.compile(r"def (\w+)\(")


def find_by_pattern(row: dict) -> dict:
    """The offline finder: the first def, surer of it where there is a docstring."""
    found = _DEFINED.search(row["content"] or "")
    return {"has_function_def": bool(found), "name": found and found[1], "confidence": 0.9 if '"""' in (row["content"] or "") else 0.6}


CODE_SQL = f"SELECT id, content FROM {_values(SNIPPETS, 'id, content, note')} UNION ALL SELECT 100 + doc_id, CASE WHEN doc_id % 3 = 0 THEN 'def f' || doc_id || '(x)' || CASE WHEN doc_id % 2 = 0 THEN ' \"\"\"told\"\"\"' ELSE '' END ELSE text END FROM documents"


@query(f"SELECT id, regexp_extract(content, 'def (\\w+)\\(', 1) AS name, 0.9::DOUBLE AS confidence FROM ({CODE_SQL}) WHERE regexp_matches(content, 'def (\\w+)\\(') AND contains(content, '\"\"\"')")
def confidence_filter(spark, sf_dir):
    """Chunks in which the finder is sure enough of a function's definition."""
    doc = F.col("doc_id")
    made = F.when(doc % 3 == 0, F.concat(F.lit("def f"), doc.cast("string"), F.lit("(x)"), F.when(doc % 2 == 0, ' """told"""').otherwise(""))).otherwise(F.col("text"))
    rows = spark.createDataFrame([r[:2] for r in SNIPPETS], "id long, content string").unionByName(table(spark, sf_dir, "documents").select((doc + 100).alias("id"), made.alias("content")))
    return agents.definitions(rows, find_by_pattern, ["content"]).select("id", "name", "confidence")


FIELD_SQL = "CASE event_id % 4 WHEN 0 THEN 'cautions' WHEN 1 THEN 'references' WHEN 2 THEN 'code_examples' ELSE 'unknown' END"
FOLDED_SQL = f"SELECT item, field, list_aggregate(flatten(list(value ORDER BY event_id)), 'string_agg', ',') AS entries, sum(len(value))::BIGINT AS n FROM (SELECT *, max(CASE WHEN event_id % 7 = 0 THEN event_id END) OVER (PARTITION BY item, field) AS cut FROM (SELECT user_id AS item, event_id, {FIELD_SQL} AS field, CASE WHEN event_id % 5 = 0 THEN [event_type, 'more'] ELSE [event_type] END AS value FROM events)) WHERE field <> 'unknown' AND (cut IS NULL OR event_id >= cut) GROUP BY item, field"


def folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documentation fields after ``events`` as a log of updates: ids divisible by 7 replace, all others append."""
    n = F.col("event_id")
    field = F.when(n % 4 == 0, "cautions").when(n % 4 == 1, "references").when(n % 4 == 2, "code_examples").otherwise("unknown")
    value = F.when(n % 5 == 0, F.array("event_type", F.lit("more"))).otherwise(F.array("event_type"))
    log = table(spark, sf_dir, "events").select(F.col("user_id").alias("item"), "event_id", field.alias("field"), value.alias("value"), (n % 7 != 0).alias("append"))
    return agents.fold_updates(log, "item", "event_id")


@query(f"SELECT item, field, entries FROM ({FOLDED_SQL})")
def field_updates(spark, sf_dir):
    return folded(spark, sf_dir).withColumn("entries", F.array_join("entries", ","))


@query(f"SELECT item, 'f' || item AS name, coalesce(sum(n) FILTER (field = 'cautions'), 0)::BIGINT AS n_cautions, coalesce(sum(n) FILTER (field = 'references'), 0)::BIGINT AS n_references, coalesce(sum(n) FILTER (field = 'code_examples'), 0)::BIGINT AS n_code_examples FROM ({FOLDED_SQL}) GROUP BY item")
def function_summary(spark, sf_dir):
    """Items of each field of a function's documentation."""
    n = lambda f: F.coalesce(F.sum(F.when(F.col("field") == f, F.size("entries"))), F.lit(0)).cast("long").alias(f"n_{f}")
    return folded(spark, sf_dir).groupBy("item").agg(*map(n, agents.FIELDS)).withColumn("name", F.concat(F.lit("f"), F.col("item").cast("string")))


LAST_SQL = "SELECT doc_id % 700 AS question_id, max(doc_id) AS doc_id FROM documents GROUP BY 1"
ENTRY_SQL = f"SELECT s.doc_id AS question_id, d.source, s.overall, d.doc_id AS asked, 'entry_' || (row_number() OVER (ORDER BY s.doc_id) - 1) AS entry FROM ({SCORES_SQL}) s JOIN ({LAST_SQL}) q ON q.question_id = s.doc_id JOIN documents d ON d.doc_id = q.doc_id"


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers (``labels``) with their questions: of questions with one id (the document's, modulo 700) the last stays,
    answers without a question go, entries are numbered through the collection in the order of question ids."""
    asked = table(spark, sf_dir, "documents").select((F.col("doc_id") % 700).alias("question_id"), "doc_id", "source").groupBy("question_id").agg(F.max_by(F.struct(F.col("doc_id").alias("asked"), "source"), "doc_id").alias("q"))
    joined = scores(spark, sf_dir).select(F.col("doc_id").alias("question_id"), "overall", "quality", "toxic").join(asked, "question_id").select("question_id", "q.asked", "q.source", "overall", "quality", "toxic")
    return positions(joined, [], "question_id", "at").withColumn("entry", F.concat(F.lit("entry_"), F.col("at").cast("string")))


@query(ENTRY_SQL)
def assemble_join(spark, sf_dir):
    return entries(spark, sf_dir).select("question_id", "source", "overall", "asked", "entry")


@query(
    f"SELECT question_id, to_json({{'id': entry, 'question': d.text, 'answer': 'from ' || e.source, 'reasoning': '', 'question_type': CASE WHEN quality = 1 THEN 'easy' ELSE 'medium' END, 'source_chunks': [asked::VARCHAR], 'metadata': {{'rationale': 'label', 'iterations': toxic::INT}}, 'quality_scores': {{'overall': overall}}, 'generation_timestamp': '2024-01-01T00:00:00Z'}})::VARCHAR AS entry"
    f" FROM ({ENTRY_SQL}) e JOIN documents d ON d.doc_id = e.asked JOIN labels l ON l.doc_id = e.question_id"
)
def dataset_jsonl(spark, sf_dir):
    """Dataset entries as JSON lines; null fields stay."""
    asked = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("asked"), F.col("text").alias("question"))
    rows = entries(spark, sf_dir).join(asked, "asked").select(
        "question_id", F.col("entry").alias("id"), "question", F.concat(F.lit("from "), "source").alias("answer"), F.lit("").alias("reasoning"), F.when(F.col("quality") == 1, "easy").otherwise("medium").alias("question_type"), F.array(F.col("asked").cast("string")).alias("source_chunks"),
        F.struct(F.lit("label").alias("rationale"), F.col("toxic").cast("int").alias("iterations")).alias("metadata"), F.struct("overall").alias("quality_scores"), F.lit("2024-01-01T00:00:00Z").alias("generation_timestamp"),
    )
    return rows.select("question_id", json_line(rows, rows.columns[1:]).alias("entry"))


@query(
    f"SELECT p.page::BIGINT AS asked, greatest(1, least(p.page, n.pages)) AS page, n.pages, d.doc_id FROM {_values([(0,), (3,), (9_999_999,)], 'page')}".replace(" t(page)", " p(page)")
    + ", (SELECT ceil(count(*) / 20.0)::BIGINT AS pages FROM documents) n JOIN (SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 20 + 1 AS page FROM documents) d ON d.page = greatest(1, least(p.page, n.pages))"
)
def paginate(spark, sf_dir):
    """Pages of 20 rows: those asked for, kept within the first and the last one."""
    placed = positions(table(spark, sf_dir, "documents").select("doc_id"), [], "doc_id", "at")
    pages = F.ceil(F.count("*") / 20).alias("pages")
    asked = spark.createDataFrame([(0,), (3,), (9_999_999,)], "asked long")
    shown = asked.join(F.broadcast(placed.agg(pages))).withColumn("page", F.greatest(F.lit(1), F.least("asked", "pages")))  # three rows and one
    return placed.withColumn("page", F.floor(F.col("at") / 20) + 1).join(F.broadcast(shown), "page").select("asked", "page", "pages", "doc_id")


@query(
    "SELECT 'sample' AS kind, row_number() OVER (ORDER BY doc_id) AS place, doc_id FROM (SELECT doc_id FROM documents ORDER BY md5('11:' || doc_id), doc_id LIMIT 5)"
    " UNION ALL SELECT 'run', k - begun + 1, doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS k, ('0x' || substr(md5('11'), 1, 7))::BIGINT % greatest(1, count(*) OVER () - 2) AS begun FROM documents) WHERE k BETWEEN begun AND begun + 2"
)
def seeded_sample(spark, sf_dir):
    """Five seeded rows in the order of ids, and three in a row from a seeded place."""
    ids = table(spark, sf_dir, "documents").select("doc_id")
    five = ids.orderBy(F.md5(F.concat(F.lit("11:"), F.col("doc_id").cast("string"))), "doc_id").limit(5)
    sample = positions(five, [], "doc_id", "at").select(F.lit("sample").alias("kind"), (F.col("at") + 1).alias("place"), "doc_id")
    start = F.conv(F.substring(F.md5(F.lit("11")), 1, 7), 16, 10).cast("long") % F.greatest(F.lit(1), F.count("*") - 2)
    placed = positions(ids, [], "doc_id", "at").join(F.broadcast(ids.agg(start.alias("start"))))
    return sample.unionByName(placed.where("at between start and start + 2").select(F.lit("run").alias("kind"), (F.col("at") - F.col("start") + 1).alias("place"), "doc_id"))


MOVES = [(0, "prev", None), (0, "next", None), (7, "next", None), (7, "prev", None), (7, "jump", 3), (7, "jump", -1), (7, "jump", 999_999_999), (7, "reset", None), (7, "current", None)]
TARGET_SQL = "CASE move WHEN 'prev' THEN place - 1 WHEN 'next' THEN place + 1 WHEN 'jump' THEN goal WHEN 'reset' THEN 0 ELSE place END"


@query(f"SELECT place::BIGINT AS place, move, goal::BIGINT AS goal, doc_id FROM {_values(MOVES, 'place, move, goal')} LEFT JOIN (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS at FROM documents) d ON d.at = {TARGET_SQL}")
def chunk_at(spark, sf_dir):
    """Where a cursor's moves lead from a place; null, and no move, where there is no row."""
    moves = spark.createDataFrame(MOVES, "place long, move string, goal long")
    placed = positions(table(spark, sf_dir, "documents").select("doc_id"), [], "doc_id", "at")
    return moves.join(placed, F.expr(f"at = {TARGET_SQL}"), "left").select("place", "move", "goal", "doc_id")


STATUS_SQL = "CASE event_type WHEN 'purchase' THEN 'approved' WHEN 'error' THEN 'rejected' WHEN 'click' THEN 'flagged' END"


@query(f"SELECT count(*) AS total, count_if(s = 'approved')::BIGINT AS approved, count_if(s = 'rejected')::BIGINT AS rejected, count_if(s = 'flagged')::BIGINT AS flagged, (count(*) - count(s))::BIGINT AS pending FROM documents LEFT JOIN (SELECT user_id, arg_max({STATUS_SQL}, event_id) AS s FROM (SELECT * FROM events WHERE event_type NOT IN ('view', 'signup')) GROUP BY user_id) r ON r.user_id = doc_id")
def review_stats(spark, sf_dir):
    """Statuses of all items by the log's last word on each; those it doesn't name are pending."""
    log = table(spark, sf_dir, "events").where("event_type not in ('view', 'signup')").select(F.col("user_id").alias("doc_id"), "event_id", F.expr(STATUS_SQL).alias("s"))
    last = log.groupBy("doc_id").agg(F.max_by("s", "event_id").alias("s"))
    count = lambda s: F.count_if(F.col("s") == s).alias(s)
    rows = table(spark, sf_dir, "documents").select("doc_id").join(last, "doc_id", "left")
    return rows.agg(F.count("*").alias("total"), count("approved"), count("rejected"), count("flagged"), (F.count("*") - F.count("s")).alias("pending"))


@query(
    "WITH w AS (SELECT n_regionkey, greatest(6, max(length(n_name)))::INT AS wn, greatest(5, max(length(n_nationkey::VARCHAR)))::INT AS wk FROM nation GROUP BY 1)"
    " SELECT n_regionkey AS sheet, '| ' || lpad('key', wk, ' ') || ' | ' || rpad('name', wn, ' ') || ' |' || chr(10) || '|' || repeat('-', wk + 1) || ':|:' || repeat('-', wn + 1) || '|' || chr(10)"
    " || string_agg('| ' || lpad(n_nationkey::VARCHAR, wk, ' ') || ' | ' || rpad(n_name, wn, ' ') || ' |', chr(10) ORDER BY n_nationkey) AS markdown FROM nation JOIN w USING (n_regionkey) GROUP BY n_regionkey, wk, wn"
)
def table_to_markdown(spark, sf_dir):
    """Rows as one pipe table a sheet, by the converter of sheets; a sheet is one file's and fits a row."""

    @F.arrow_udf("string")
    def shown(sheets: pa.Array) -> pa.Array:
        return pa.array([pipe_table([["key", "name"], *[[r["n_nationkey"], r["n_name"]] for r in rows]]) for rows in sheets.to_pylist()], pa.string())

    listed = table(spark, sf_dir, "nation").groupBy(F.col("n_regionkey").alias("sheet")).agg(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("rows"))
    return listed.select("sheet", shown("rows").alias("markdown"))


@query()
def html_to_markdown(spark, sf_dir):
    return html_table(table(spark, sf_dir, "pages").select("page_id", "url", "html"), "html")

