"""Results of costly steps, kept in a table by the digest of what they were made of."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.config import require_table


def cached(df: DataFrame, path: str, content: Sequence[str], step: Callable[[DataFrame], DataFrame], made: Sequence[str], version: str = "") -> DataFrame:
    """``df`` with the columns ``made`` of ``step(df)``. Rows whose ``content`` columns, and ``version`` (such as whether
    summaries are embedded), are in the table at ``path`` take them from there; the others go through ``step``
    once for each content and are added to it. Place and id of a row play no part."""
    spark, names = df.sparkSession, list(dict.fromkeys([*content, *made]))
    parts = [F.coalesce(F.sha2(F.col(c).cast("string"), 256), F.lit("-")) for c in content]
    keyed = df.withColumn("cache_key", F.sha2(F.concat_ws(":", F.lit(version), *parts), 256))
    if not _exists(df, path):
        missing = keyed
    else:
        missing = keyed.join(spark.read.parquet(path).select("cache_key"), "cache_key", "left_anti")
    fresh = step(missing.dropDuplicates(["cache_key"]).select("cache_key", *content)).select("cache_key", *[c for c in names if c in made])
    fresh.write.mode("append").parquet(path)
    single = spark.read.parquet(path).dropDuplicates(["cache_key"])  # two runs at once, or a retry, may both have added a key
    return keyed.join(single, "cache_key").drop("cache_key")


def _exists(df: DataFrame, path: str) -> bool:
    """Whether there are files of a table: a first write that was stopped leaves a folder without any."""
    try:
        require_table(df.sparkSession, path)
    except ValueError:
        return False
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return any(not x.getPath().getName().startswith(("_", ".")) for x in folder.getFileSystem(conf).listStatus(folder))


def purge(df: DataFrame, path: str) -> None:
    """Remove the table at ``path``, if there is one."""
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(conf).delete(folder, True)
