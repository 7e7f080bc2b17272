"""What is written: consolidated markdown, the chunk store, and datasets as JSON lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LINK = "struct<chunk_id:bigint,chunk_index:bigint,relation:string,common_topic:string>"
#: Extras that are lists.
LISTS = ("header_levels",)
# The separator of consolidated files; ``block`` has their header lines.
SEPARATOR = "\n\n" + "=" * 80 + "\n\n"


def block(path: Column, suffix: Column, content: Column, timestamp: Column) -> Column:
    """A document under its header lines; nulls are empty."""
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    return F.concat(F.lit("# SOURCE: "), text(path), F.lit("\n# TIMESTAMP: "), text(timestamp), F.lit("\n# FORMAT: "), text(suffix), F.lit("\n---\n"), text(content))


def consolidated(df: DataFrame, order_col: str, made: Column) -> DataFrame:
    """``order_col`` and ``block``: in that order the blocks are the one file; all but the first begin with a separator.
    Rows that tie for the first place all go without one, so the column should be unique."""
    first = df.agg(F.min(order_col)).scalar()
    return df.select(F.col(order_col), F.concat(F.when(F.col(order_col) == first, "").otherwise(SEPARATOR), made).alias("block"))


def write_consolidated(blocks: DataFrame, order_col: str, path: str) -> None:
    """Text files whose names' order is the blocks' order: put together they are the consolidated file and a final line
    break. The line break that ends a block is the first one of the separator after it."""
    ended = F.when(F.startswith("block", F.lit(SEPARATOR)), F.expr("substring(block, 2)")).otherwise(F.col("block"))
    blocks.repartitionByRange(order_col).sortWithinPartitions(order_col).select(ended).write.mode("overwrite").option("lineSep", "\n").text(path)


def metadata(source: Column, chunk_index: Column, start: Column, end: Column, headers: Column, points: Column, **extras: Column) -> list[Column]:
    """The flat metadata columns of a stored chunk: numbers as text, lists as JSON, no points as null. Of ``extras`` lists are JSON
    text, and other values stay as they are."""
    return [
        source.alias("source_file"),
        chunk_index.cast("string").alias("chunk_index"),
        start.cast("string").alias("start_char"),
        end.cast("string").alias("end_char"),
        F.to_json(headers).alias("headers"),
        F.when(F.size(points) > 0, F.to_json(points, {"ignoreNullFields": "false"})).alias("summary_points"),
        *[(F.to_json(c) if name in LISTS else c).alias(name) for name, c in extras.items()],
    ]


def decoded(stored: DataFrame, id_type: str = "bigint") -> DataFrame:
    """A store's rows with numbers as numbers and headers, levels and points out of their JSON; a chunk without points has an
    empty list, text that is no JSON gives null. Ids in links are of ``id_type``."""
    link = LINK.replace("chunk_id:bigint", f"chunk_id:{id_type}")
    point = f"struct<text:string,prev_link:{link},next_link:{link}>"
    whole = lambda c: F.col(c).cast("long").alias(c)
    lists = [F.from_json("headers", "array<string>").alias("headers"), F.from_json(F.coalesce("summary_points", F.lit("[]")), f"array<{point}>").alias("summary_points")]
    if "header_levels" in stored.columns:
        lists.append(F.from_json("header_levels", "array<int>").alias("header_levels"))
    held = ("chunk_index", "start_char", "end_char", "headers", "summary_points", "header_levels")
    return stored.select(*[c for c in stored.columns if c not in held], *map(whole, held[:3]), *lists)


def json_line(df: DataFrame, columns: Sequence[str]) -> Column:
    """One dataset entry as JSON; null fields are kept."""
    return F.to_json(F.struct(*[df[c] for c in columns]), {"ignoreNullFields": "false"})


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_json_array(df: DataFrame, order_col: str, columns: Sequence[str], path: str) -> None:
    """Text files whose names' order is the entries' order: put together they are one JSON array, with null fields. Values of
    ``order_col`` are unique; no entries give an empty array."""
    ends = df.agg(F.min(order_col).alias("first"), F.max(order_col).alias("last"))
    entry = F.to_json(F.struct(*columns), {"ignoreNullFields": "false", "pretty": "true"})
    rows = df.join(F.broadcast(ends))  # one row
    line = F.concat(F.when(F.col(order_col) == F.col("first"), "[\n").otherwise(""), entry, F.when(F.col(order_col) == F.col("last"), "\n]").otherwise(","))
    if df.isEmpty():
        df.sparkSession.createDataFrame([("[]",)], "value string").write.mode("overwrite").text(path)
    else:
        rows.repartitionByRange(order_col).sortWithinPartitions(order_col).select(line.alias("value")).write.mode("overwrite").option("lineSep", "\n").text(path)
