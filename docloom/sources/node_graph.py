"""A graph of code as tables of nodes and edges, read from node-link JSON.

A file is one object with ``nodes`` and ``links`` (or ``edges``), or has an object a line: a node (with ``id``) or an edge (with ``source`` and ``target``), so that
a large graph is read and written by many tasks. Attributes of any shape stay with their node or edge as a variant.

Defined results: what can't be read, or holds no node and no edge, gives None; objects of other kinds, and nodes without id, are left out; a node without a vector
has a null one; ids are text; nodes given twice stay twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.session import Staged

# The fields of a node.
FIELDS = ("type", "name", "summary", "file_path")


@dataclass
class Graph:
    """``nodes``: entity_id, type, name, summary, file_path, embedding array<double>, attributes. ``edges``: source, target, attributes."""

    nodes: DataFrame
    edges: DataFrame


def _text(value: str, field: str) -> Column:
    return F.try_variant_get(value, f"$.{field}", "string")


def _objects(held: DataFrame, *fields: str) -> DataFrame:
    lists = [F.coalesce(F.try_variant_get("v", f"$.{f}", "array<variant>"), F.array().cast("array<variant>")) for f in fields]
    return held.select(F.explode(F.concat(*lists)).alias("x"))


def load(spark: SparkSession, path: str, lines: bool = False) -> Graph | None:
    """The graph at ``path``; with ``lines`` its files have an object a line."""
    try:
        rows = spark.read.text(path, wholetext=not lines)
        held = Staged(rows.select(F.try_parse_json("value").alias("v")).where("v is not null"), "graph").df
        alone = held.select(F.col("v").alias("x"))
        nodes = _objects(held, "nodes").unionByName(alone.where(_text("x", "source").isNull()))
        edges = _objects(held, "links", "edges").unionByName(alone)
        nodes = nodes.select(_text("x", "id").alias("entity_id"), *[_text("x", f).alias(f) for f in FIELDS], F.try_variant_get("x", "$.embedding", "array<double>").alias("embedding"), F.col("x").alias("attributes")).where("entity_id is not null")
        edges = edges.select(_text("x", "source").alias("source"), _text("x", "target").alias("target"), F.col("x").alias("attributes")).where("source is not null and target is not null")
        return None if nodes.isEmpty() and edges.isEmpty() else Graph(nodes, edges)
    except PySparkException:
        return None


def save(nodes: DataFrame, edges: DataFrame | None, path: str) -> None:
    """Write nodes (with ``id``) and edges (with ``source`` and ``target``), all their columns as attributes, an object a line."""
    line = lambda df: df.select(F.to_json(F.struct(*df.columns)).alias("value"))
    rows = line(nodes) if edges is None else line(nodes).unionByName(line(edges))
    rows.write.mode("overwrite").text(path)
