"""Queries over lines, headers, sections and chunks of markdown.

``documents`` have no headers and no blank lines, so markdown is made of them: a header before every fourth line and,
for paragraphs, every line break doubled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions.text import numbered
from docloom.operators import chunking
from docloom.operators.datasets import ORACLE_SQL, QUERIES
from docloom.operators.queries import query
from docloom.session import table

__all__ = ["ORACLE_SQL", "QUERIES"]

MD_SQL = "SELECT doc_id, list_aggregate(list_transform(string_split(text, chr(10)), lambda x, i: CASE WHEN i % 4 = 1 THEN repeat('#', 1 + ((i * 7 + doc_id) % 6)::INT) || ' h' || i || chr(10) || x ELSE x END), 'string_agg', chr(10)) AS md FROM documents"
WIDE_SQL = f"SELECT doc_id, replace(md, chr(10), chr(10) || chr(10)) AS md FROM ({MD_SQL})"
IS_HEADER = "regexp_matches(line, '^(#{1,6})\\s+(.*)$')"


def markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents with a header before every fourth line."""
    head = lambda x, i: F.when(i % 4 == 0, F.concat(F.repeat(F.lit("#"), (1 + ((i + 1) * 7 + F.col("doc_id")) % 6).cast("int")), F.lit(" h"), i + 1, F.lit("\n"), x)).otherwise(x)
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(F.transform(F.split("text", "\n"), head), "\n").alias("md"))


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markdown(spark, sf_dir).withColumn("md", F.replace("md", F.lit("\n"), F.lit("\n\n")))


def _lines_sql(md: str) -> str:
    return f"SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS n FROM (SELECT doc_id, string_split(md, chr(10)) AS l FROM ({md}))"


def _headers_sql(md: str) -> str:
    pattern = "'^(#{1,6})\\s+(.*)$'"
    return f"SELECT doc_id, n, length(regexp_extract(line, {pattern}, 1)) AS level, regexp_extract(line, {pattern}, 2) AS title FROM ({_lines_sql(md)}) WHERE {IS_HEADER}"


def _stacks_sql(md: str) -> str:
    """Headers with number i, depth and stack: depth i is i plus the least of 0 and the running minimum of level - i; the
    stack's entry at a depth is the last title at that depth."""
    depth = f"SELECT *, i + least(0, min(level - i) OVER (PARTITION BY doc_id ORDER BY n)) AS depth FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n) AS i FROM ({_headers_sql(md)}))"
    last = ", ".join(f"last_value(CASE WHEN depth = {p} THEN title END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY n) AS t{p}" for p in range(1, 7))
    shown = ", ".join(f"CASE WHEN depth >= {p} THEN t{p} END" for p in range(1, 7))
    return f"SELECT doc_id, n, level, title, i, depth, concat_ws(' > ', {shown}) AS stack FROM (SELECT *, {last} FROM ({depth}))"


def _sections_sql(md: str) -> str:
    return (
        f"SELECT c.doc_id, section, content, coalesce(stack, '') AS headers FROM (SELECT doc_id, g::BIGINT AS section, string_agg(line, chr(10) ORDER BY n) AS content FROM (SELECT *, sum(h::INT) OVER (PARTITION BY doc_id ORDER BY n) AS g FROM (SELECT doc_id, n, line, {IS_HEADER} AS h FROM ({_lines_sql(md)}))) WHERE NOT h GROUP BY doc_id, g) c"
        f" LEFT JOIN (SELECT doc_id, max(i) AS last FROM ({_stacks_sql(md)}) GROUP BY doc_id) m ON m.doc_id = c.doc_id LEFT JOIN ({_stacks_sql(md)}) s ON s.doc_id = c.doc_id AND s.i = least(section + 1, last)"
    )


def chunks_sql(md: str, size: int) -> str:
    """Chunks by recursion over the pieces of each section: 0 paragraph, 1 sentence, 2 slice, 3 open, 4 close."""
    fits = f"length(cur) + length(t) <= {size}"
    return f"""
WITH RECURSIVE s AS MATERIALIZED ({_sections_sql(md)}),
para AS (SELECT doc_id, section, unnest(l) AS p, generate_subscripts(l, 1) AS a FROM (SELECT doc_id, section, string_split(content, chr(10) || chr(10)) AS l FROM s WHERE length(content) > {size})),
sent AS (SELECT * FROM (SELECT doc_id, section, a, b, regexp_replace(x, '^\\s+|\\s+$', '', 'g') AS t FROM (SELECT doc_id, section, a, unnest(l) AS x, generate_subscripts(l, 1) AS b FROM (SELECT *, string_split_regex(p, '[.!?]+') AS l FROM para WHERE length(p) > {size}))) WHERE t <> ''),
pieces AS (SELECT doc_id, section, a, 0 AS b, 0 AS c, 0 AS kind, p AS t FROM para WHERE length(p) <= {size}
    UNION ALL SELECT doc_id, section, a, 0, 0, 3, '' FROM para WHERE length(p) > {size}
    UNION ALL SELECT doc_id, section, a, 1000000000, 0, 4, '' FROM para WHERE length(p) > {size}
    UNION ALL SELECT doc_id, section, a, b, k, CASE WHEN (k + 1) * {size} < length(t) THEN 2 ELSE 1 END, substr(t, (k * {size} + 1)::BIGINT, {size}) FROM (SELECT *, unnest(range(0, (length(t) + {size} - 1) // {size})) AS k FROM sent)),
numbered AS MATERIALIZED (SELECT doc_id, section, kind, t, row_number() OVER (PARTITION BY doc_id, section ORDER BY a, b, c) AS i FROM pieces),
fold AS (SELECT DISTINCT doc_id, section, 0::BIGINT AS i, '' AS cur, NULL::VARCHAR AS done, false AS large, NULL::VARCHAR AS slice FROM numbered
    UNION ALL SELECT n.doc_id, n.section, n.i,
        CASE WHEN kind > 1 THEN '' WHEN {fits} THEN CASE WHEN cur = '' THEN t WHEN kind = 0 THEN cur || chr(10) || chr(10) || t ELSE cur || '. ' || t END ELSE t END,
        CASE WHEN kind < 2 AND {fits} THEN NULL WHEN kind IN (0, 3) THEN CASE WHEN regexp_matches(cur, '\\S') THEN cur END WHEN cur <> '' THEN cur || '.' END,
        kind IN (1, 2, 4), CASE WHEN kind = 2 THEN t END
    FROM fold f JOIN numbered n ON n.doc_id = f.doc_id AND n.section = f.section AND n.i = f.i + 1),
made AS (SELECT doc_id, section, i, 0 AS k, done AS content, large, false AS cut FROM fold WHERE done IS NOT NULL
    UNION ALL SELECT doc_id, section, i, 1, slice, true, true FROM fold WHERE slice IS NOT NULL
    UNION ALL SELECT doc_id, section, max(i) + 1, 0, arg_max(cur, i), false, false FROM fold GROUP BY doc_id, section HAVING regexp_matches(arg_max(cur, i), '\\S')
    UNION ALL SELECT doc_id, section, 0, 0, content, false, false FROM s WHERE length(content) <= {size})
SELECT m.doc_id, row_number() OVER (PARTITION BY m.doc_id ORDER BY m.section, m.i, m.k) - 1 AS chunk_index, s.headers, m.content, CASE WHEN length(s.content) <= {size} THEN length(s.content) ELSE 0 END AS end_char, m.large AS large_paragraph, m.cut AS truncated FROM made m JOIN s ON s.doc_id = m.doc_id AND s.section = m.section"""


@query(_headers_sql(MD_SQL))
def md_headers(spark, sf_dir):
    return chunking.headers(markdown(spark, sf_dir), "doc_id", "md")


@query(f"SELECT doc_id, n, depth, title, stack FROM ({_stacks_sql(MD_SQL)})")
def header_stack(spark, sf_dir):
    return chunking.stacks(markdown(spark, sf_dir), "doc_id", "md").select("doc_id", "n", "depth", "title", F.array_join("stack", " > ").alias("stack"))


def chunked(md: DataFrame, size: int) -> DataFrame:
    """Chunks with their headers as one text."""
    return chunking.chunk(md, "doc_id", "md", size).select("doc_id", "chunk_index", F.array_join("headers", " > ").alias("headers"), "content", F.col("end_char").cast("long").alias("end_char"), "large_paragraph", "truncated")


@query(f"SELECT doc_id, chunk_index, content FROM ({chunks_sql(MD_SQL, 400)}) WHERE list_contains(string_split(headers, ' > '), 'h5')")
def chunks_with_header(spark, sf_dir):
    """Chunks under the title 'h5', in that very case."""
    return chunking.chunk(markdown(spark, sf_dir), "doc_id", "md", 400).where(F.array_contains("headers", "h5")).select("doc_id", "chunk_index", "content")


@query(_sections_sql(MD_SQL))
def md_sections(spark, sf_dir):
    """Content between headers, under the stack of the header that ends it."""
    return chunking.sections(markdown(spark, sf_dir), "doc_id", "md").withColumn("headers", F.array_join("headers", " > "))


@query(f"SELECT doc_id, chunk_index, content, end_char FROM ({chunks_sql(MD_SQL, 400)}) WHERE end_char = length(content)")
def chunk_small(spark, sf_dir):
    """Sections of at most 400 characters: one chunk as they are, blank ones too, with their place."""
    return chunked(markdown(spark, sf_dir), 400).where(F.col("end_char") == F.length("content")).select("doc_id", "chunk_index", "content", "end_char")


@query(chunks_sql(WIDE_SQL, 400))
def chunk_paragraphs(spark, sf_dir):
    """Paragraphs packed up to 400 characters."""
    return chunked(wide(spark, sf_dir), 400)


@query(chunks_sql(MD_SQL, 120))
def chunk_sentences(spark, sf_dir):
    """Sections of one long paragraph: its sentences packed up to 120 characters."""
    return chunked(markdown(spark, sf_dir), 120)


@query(f"SELECT doc_id, chunk_index, content FROM ({chunks_sql(WIDE_SQL, 40)}) WHERE truncated")
def chunk_hardcut(spark, sf_dir):
    """Slices of sentences of over 40 characters, the last of which begins the next chunk."""
    return chunking.chunk(wide(spark, sf_dir), "doc_id", "md", 40).where("truncated").select("doc_id", "chunk_index", "content")


@query(chunks_sql(MD_SQL, 1000))
def chunk_documents(spark, sf_dir):
    """Header-aware chunks of at most about 1,000 characters."""
    return chunked(markdown(spark, sf_dir), 1000)


LINES_SQL = "SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS n, len(l) AS n_lines FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)"
START_SQL = "CASE WHEN n_lines > 60 THEN 60 ELSE ('0x' || substr(md5('11:' || doc_id), 1, 7))::BIGINT % (greatest(0, n_lines - 50) + 1) END"


def line_window(text: str, id_col: str, start: int, seed: int, length: int = 50):
    """struct<start, stop> of lines: ``length`` lines from ``start`` (from 0), or from a seeded place in a text that hasn't
    so many lines."""
    n = F.size(F.split(text, "\n"))
    seeded = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string"))), 1, 7), 16, 10).cast("long") % (F.greatest(F.lit(0), n - length) + 1)
    begin = F.when(n > start, F.lit(start)).otherwise(seeded).cast("int")
    return F.struct(begin.alias("start"), F.least(begin + length, n).alias("stop"))


@query(f"SELECT doc_id, n, printf('%4d | %s', n, line) AS shown FROM (SELECT *, {START_SQL} AS first FROM ({LINES_SQL})) WHERE n > first AND n <= first + 50")
def line_range(spark, sf_dir):
    """Fifty numbered lines of every document from line 60 on, or from a seeded place of a shorter one."""
    rows = table(spark, sf_dir, "documents").withColumn("w", line_window("text", "doc_id", 60, 11))
    held = rows.select("doc_id", "w", F.posexplode(F.slice(F.split("text", "\n"), F.col("w.start") + 1, F.col("w.stop") - F.col("w.start"))).alias("k", "line"))
    n = (F.col("w.start") + F.col("k") + 1).cast("long")
    return held.select("doc_id", n.alias("n"), numbered(n, F.col("line")).alias("shown"))


@query(
    f"WITH l AS (SELECT * FROM (SELECT *, {START_SQL} AS first FROM ({LINES_SQL})) WHERE n > first AND n <= first + 50) SELECT h.doc_id, h.n AS hit, c.n, CASE WHEN c.n = h.n THEN '>>> ' ELSE '    ' END || printf('%4d | %s', c.n, c.line) AS shown"
    " FROM l h JOIN l c ON c.doc_id = h.doc_id AND c.n BETWEEN h.n - 2 AND h.n + 3 WHERE contains(lower(h.line), 'apache')"
)
def keyword_context(spark, sf_dir):
    """Lines of the same fifty that hold a word in any case, each with the lines around it. No shuffle."""
    rows = table(spark, sf_dir, "documents").select("doc_id", F.split("text", "\n").alias("lines"), line_window("text", "doc_id", 60, 11).alias("w"))
    rows = rows.withColumn("held", F.slice("lines", F.col("w.start") + 1, F.col("w.stop") - F.col("w.start")))
    hits = F.filter(F.transform("held", lambda x, i: F.when(F.contains(F.lower(x), F.lit("apache")), i)), lambda i: i.isNotNull())
    found = rows.select("doc_id", "w", "held", F.explode(hits).alias("i"))
    # In the order of the window, the line before the last one shown before a hit is two above it.
    begin = F.greatest(F.lit(0), F.col("i") - 2)
    near = found.select("doc_id", "w", "i", begin.alias("begin"), F.posexplode(F.slice("held", begin + 1, F.least(F.size("held"), F.col("i") + 4) - begin)).alias("k", "line"))
    n, hit = (F.col("w.start") + F.col("begin") + F.col("k") + 1).cast("long"), (F.col("w.start") + F.col("i") + 1).cast("long")
    return near.select("doc_id", hit.alias("hit"), n.alias("n"), F.concat(F.when(n == hit, ">>> ").otherwise("    "), numbered(n, F.col("line"))).alias("shown"))
