"""The corpus pipeline: reject toxic documents, drop near-duplicates, mask personal data, mix sources, encode.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns a DataFrame; all
but the last return the columns of documents. Stages may be written to Parquet and read again in between.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm import bpe, dartminhash, mixing, pii, toxicity
from docloom.llm.queries import MIX_EPOCHS, MIX_SEED, MIX_WEIGHTS, RANK_FILE, mix_levels
from docloom.session import table

#: Documents that score at least this are rejected.
TOXIC_LIMIT = 0.5
#: The mix takes at most this share of the tokens that reach it.
MIX_SHARE = (9, 10)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the toxicity model, fitted on the labels of ``sf_dir``, does not reject. Null and empty texts score by the bias alone; rows
    without id are judged and do not train; repeated rows stay or go together; texts are read whole; an empty table gives no rows, and
    labels of no use reject by 0.5; columns of any name come back as they were."""
    model = toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model, TOXIC_LIMIT)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near-duplicates, the one with the least id. Null texts are empty, and empty texts are one class; rows of one id are one
    class, and of those that share the least id the one with the least digest stays; of rows without id one of each text stays, unless a row with an
    id has that text; texts are read whole; an empty table gives no rows; columns of any name but __digest come back as they were."""
    return dartminhash.keep_one(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with spans of personal data replaced by tags and ``n_chars`` brought up to date. A null text stays null and has null characters;
    empty texts stay empty; overlapping spans are one; repeated rows give repeated results; texts are read whole; an empty table gives no rows;
    other columns come back as they were."""
    masked = pii.redact_table(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the hierarchical budget takes them. A null source or language is a node of its own; texts without tokens cost nothing and
    come with every pass that reaches their place; rows of one id, or of none, are taken together; ties of the budget go by the
    child's name; texts are counted whole; an empty table gives no rows; columns of any name come back as they were."""
    taken = mixing.select(docs, mix_levels(), MIX_WEIGHTS, MIX_SHARE, MIX_EPOCHS, MIX_SEED)
    return mixing.repeat_rows(taken).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row. Null texts are empty, and empty texts have no ids; a null id is carried through;
    repeated rows give repeated results; texts are encoded whole; an empty table gives no rows; other columns are not looked at."""
    import public_tokenizers

    back = bpe.round_trip(docs, public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN)
    return back.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", mask_personal_data),
    ("mixing", mix_sources),
    ("encoding", encode),
]

#: The classifier and the encoder are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
