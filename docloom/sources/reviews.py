"""Review of a dataset: items with the status that the log of changes leaves them, and changes saved in batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

# The keys of a multiple-choice item's options.
OPTIONS = ("A", "B", "C", "D")
ITEMS = "_id string, question string, answer string, verified string"
CHANGES = "item_id string, seq long, old string, new string, timestamp string"


def options(more: Column) -> Column:
    """The options of a multiple-choice item, array<struct<key, text>> in the order of their letters; empty for other items."""
    return F.filter(F.array(*[F.struct(F.lit(k).alias("key"), F.try_element_at(more, F.lit(k)).alias("text")) for k in OPTIONS]), lambda o: F.map_contains_key(more, o["key"]))


def middle_fields(more: Column) -> Column:
    """The other fields of an item that are neither fixed nor options, as a map."""
    return F.map_filter(more, lambda k, _: ~k.isin(*OPTIONS, "_id", "question", "answer", "verified"))


def load_items(spark: SparkSession, path: str, samples: list[tuple]) -> DataFrame:
    """The collection's items; ``samples`` (rows of ``ITEMS``) where there is no table or it is empty."""
    try:
        items = spark.read.parquet(path)
        if not items.isEmpty():
            return items
    except AnalysisException:
        pass
    return spark.createDataFrame(samples, ITEMS)


def save_changes(changes: DataFrame, path: str) -> bool:
    """Add a batch of changes to the log; nothing is written, and False returned, if there are none. Changes that leave the
    status as it was are left out."""
    real = changes.where(~F.col("old").eqNullSafe(F.col("new")))
    if real.isEmpty():
        return False
    real.write.mode("append").parquet(path)
    return True


def statuses(items: DataFrame, changes: DataFrame) -> DataFrame:
    """_id, status: the stored value under the last change of the log."""
    last = changes.groupBy(F.col("item_id").alias("_id")).agg(F.max_by(F.struct("new"), "seq").alias("last"))
    return items.select("_id", "verified").join(last, "_id", "left").select("_id", F.when(F.col("last").isNotNull(), F.col("last.new")).otherwise(F.col("verified")).alias("status"))
