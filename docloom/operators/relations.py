"""How chunks relate to those after them: by the rare terms that both hold.

A term is a word of at least ``LETTERS`` letters. How many chunks hold a term is counted once, and only terms that at most one chunk in ``RARE`` holds (or
``FEW`` chunks, in a small collection) go on, so what the two sides of a pair are compared by is small. Two chunks relate if they share such
a term; the rarest ones are their topic.

Defined results: only A to Z are lower-cased; null and blank texts have no terms; ties of rareness go by the term; repeated terms count once; texts are taken whole; chunks whose
neighbour is not there relate to nothing; ids are unique. Terms that many chunks hold meet in a join that adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.session import Staged

LETTERS, RARE, FEW, TOPICS = 5, 50, 3, 3
#: A fixed pattern, the same in Spark and in SQL.
TERM = f"[a-zà-ÿ]{{{LETTERS},}}"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def terms(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, term), each once."""
    low = F.translate(F.coalesce(F.col(text_col), F.lit("")), _UPPER, _UPPER.lower())
    return df.select(F.col(id_col).alias("id"), F.explode(F.array_distinct(F.regexp_extract_all(low, F.lit(TERM), F.lit(0)))).alias("term"))


def rare_terms(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, term, n) of the rare terms of each chunk, ``n`` being the chunks that hold it."""
    held = Staged(terms(df, id_col, text_col), "terms").df
    most = F.greatest(F.lit(FEW), F.floor(F.lit(df.count()) / RARE))
    counts = held.groupBy("term").agg(F.count("*").alias("n")).where((F.col("n") > 1) & (F.col("n") <= most))
    return held.join(counts, "term").select("id", "term", "n")


def related(pairs: DataFrame, rare: DataFrame) -> DataFrame:
    """from_id, to_id, shared (rare terms in common), topic (the rarest of them) of the pairs (from_id, to_id) that relate."""
    ahead = rare.select(F.col("id").alias("from_id"), "term", "n")
    there = rare.select(F.col("id").alias("to_id"), "term")
    both = pairs.where("to_id is not null").join(ahead, "from_id").join(there, ["to_id", "term"])
    listed = both.groupBy("from_id", "to_id").agg(F.array_sort(F.collect_list(F.struct("n", "term"))).alias("t"))
    return listed.select("from_id", "to_id", F.size("t").cast("long").alias("shared"), F.array_join(F.transform(F.slice("t", 1, TOPICS), lambda x: x["term"]), ", ").alias("topic"))
