"""The consolidated markdown file that runs append to: one stream of bytes, written in parts by many tasks.

A run's documents follow each other by path, each under its header lines, and all but the very first begin with a separator. Where a block lies in
the whole file is a running sum of the blocks' lengths in bytes, and a run goes on where the file ended, so no block waits for another.
Runs are batches of a store: a run that fails leaves nothing, and the last run can be done again. ``export`` writes the
stream as text files whose names' order is that of the bytes.

Defined results: null paths, suffixes, texts are empty; documents with the same path follow each other in any order; a run without
documents changes nothing; texts of any length are one block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.operators.adjacency import numbered
from docloom.sources import sinks
from docloom.sources.store import Batch, Store, put_numbered

NAME = "consolidated"


def append(store: Store, docs: DataFrame, run: str, timestamp: Column, name: str = NAME) -> Batch:
    """Add a run's documents (path, suffix, markdown). A run of a name that is there already must be the last one, whose place it takes."""
    held = store.manifest(name)
    if held is not None and run in [b.name for b in held.batches[:-1]]:
        raise ValueError(f"run {run!r} is followed by others")

    def blocks(start: int) -> DataFrame:
        made = docs.select(F.col("path"), sinks.block(F.col("path"), F.col("suffix"), F.col("markdown"), timestamp).alias("block"))
        first = F.octet_length("block").cast("long")
        sized = made.withColumn("length", first + len(sinks.SEPARATOR))
        placed = numbered(sized, ["path"], "before", "length")
        skip = 0 if start else len(sinks.SEPARATOR)  # the very first block of the file has no separator
        opens = (F.col("before") == 0) & F.lit(start == 0)
        offset = F.lit(start) + F.when(opens, F.lit(0)).otherwise(F.col("before") - F.lit(skip))
        placed = placed.select(F.lit(run).alias("run"), "path", offset.cast("long").alias("offset"), F.when(opens, F.col("block")).otherwise(F.concat(F.lit(sinks.SEPARATOR), "block")).alias("block"))
        return placed.withColumn("last", F.col("offset") + F.octet_length("block") - 1)

    return put_numbered(store, name, run, blocks, "last", key="offset")


def blocks(store: Store, name: str = NAME) -> DataFrame:
    """run, path, offset and length in bytes, and block, with the separator before it."""
    return store.read(name).select("run", "path", "offset", (F.col("last") - F.col("offset") + 1).alias("length"), "block")


def export(store: Store, path: str, name: str = NAME) -> None:
    """Text files which put together are the file and a final line break: the line break that ends a block is the first one of the
    separator after it."""
    ended = F.when(F.col("offset") > 0, F.expr("substring(block, 2)")).otherwise(F.col("block"))
    rows = blocks(store, name).repartitionByRange("offset").sortWithinPartitions("offset")
    rows.select(ended.alias("value")).write.mode("overwrite").option("lineSep", "\n").text(path)
