"""Numbers and neighbours of rows in the order of an integer id, without a whole group in one task.

The input is read once, into a staged table. If that has more than ``SPAN`` rows or ``SPAN_BYTES``, they are dealt by ranges of the groups and the id and staged
again, each range a span: so a span has about ``SPAN`` rows, or fewer where rows are wide, however the ids are spread, and nothing about ids comes to the driver. Windows
run within a span of a group, and a second window over one row per span carries the counts and edge ids
across. A group with a third of all rows is thus spread over many tasks.

Defined results: ids are unique within a group; a null group value is a group of its own; rows with a null id
come first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.session import Staged

#: Rows and staged (compressed) bytes of a span.
SPAN, SPAN_BYTES = 262_144, 32 << 20


def _spans(df: DataFrame, by: Sequence[str], id_col: str) -> tuple[DataFrame, DataFrame, Window, Window, Column]:
    """Rows with their span, one row per span of a group, the two windows and the condition that joins them."""
    held = Staged(df, "adjacent-rows")
    spans = max(-(-held.df.count() // SPAN), -(-held.size() // SPAN_BYTES))
    if spans > 1:
        ranged = held.df.repartitionByRange(spans, *by, id_col).withColumn("_span", F.spark_partition_id())
        rows = Staged(ranged, "adjacent-spans").df
        held.drop()
    else:
        rows = held.df.withColumn("_span", F.lit(0))
    keys = [*by, "_span"]
    edges = rows.groupBy(*[F.col(k).alias(f"_e_{k}") for k in keys]).agg(F.min(id_col).alias("_lo"), F.max(id_col).alias("_hi"), F.count("*").alias("_n"))
    inner = Window.partitionBy(*keys).orderBy(id_col)
    outer = Window.partitionBy(*[f"_e_{k}" for k in by]).orderBy("_e__span")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_e_{k}"))
    return rows, edges, inner, outer, same


def neighbours(df: DataFrame, by: Sequence[str], id_col: str, previous: str = "previous_id", following: str = "next_id") -> DataFrame:
    """``df`` with the ids before and after each row in its group (in the whole table if ``by`` is empty)."""
    rows, edges, inner, outer, same = _spans(df, by, id_col)
    near = rows.withColumns({"_prev": F.lag(id_col).over(inner), "_next": F.lead(id_col).over(inner)})
    edges = edges.withColumns({"_before": F.lag("_hi").over(outer), "_after": F.lead("_lo").over(outer)})
    found = near.join(edges, same)
    return found.select(*df.columns, F.coalesce("_prev", "_before").alias(previous), F.coalesce("_next", "_after").alias(following))


def positions(df: DataFrame, by: Sequence[str], id_col: str, name: str = "chunk_index", size: str | None = None) -> DataFrame:
    """``df`` with the place of each row in its group, from 0. With ``size``, the sum of that column over the rows before
    it, as for rows that stand for several."""
    rows, edges, inner, outer, same = _spans(df, by, id_col)
    before = lambda c, w: F.coalesce(F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    if size is None:
        placed = rows.withColumn("_at", F.row_number().over(inner).cast("long") - 1)
    else:
        placed = rows.withColumn("_at", before(F.col(size), inner))
        sums = rows.groupBy(*[F.col(k).alias(f"_e_{k}") for k in [*by, "_span"]]).agg(F.sum(size).alias("_n"))
        edges = sums
    edges = edges.withColumn("_done", before(F.col("_n"), outer))
    return placed.join(edges, same).select(*df.columns, (F.col("_at") + F.col("_done")).cast("long").alias(name))


def numbered(df: DataFrame, order: Sequence[str], name: str, size: str | None = None) -> DataFrame:
    """``df`` with the place of each row, from 0, in the order of any columns; with ``size`` the sum of that column over the
    rows before it. Rows are dealt by ranges of the order and staged, so no task holds more than a range; rows that tie
    in all columns of ``order`` are numbered in any order."""
    ranged = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    rows = Staged(ranged, "numbered").df
    inner, weight = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1), F.lit(1) if size is None else F.col(size)
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy(F.col("_part").alias("_p")).agg(F.sum(weight).alias("_n")).select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_done"))  # one row a range
    placed = rows.withColumn("_at", F.coalesce(F.sum(weight).over(inner), F.lit(0)))
    return placed.join(F.broadcast(parts), F.col("_part") == F.col("_p")).select(*df.columns, (F.col("_at") + F.col("_done")).cast("long").alias(name))
