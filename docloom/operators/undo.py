"""A review log with undo: one stack over all items, matched in parallel.

A log has changes (an item's status from ``old`` to ``new``), undos, each of which takes back the last change of any item that still
stands, and saves, after which nothing before can be taken back. That is the matching of brackets. The log is cut into ranges of its
order; a range matches what it can by itself and is reduced to the undos that found nothing, whether there was a save, and the changes that
still stand. One pass over the reduced ranges, a row each, tells how many of a range's standing changes later ranges take back,
and by which undos. No task sees more than a range, or one row a range.

Defined results: an undo without a change to take back does nothing; places (``seq``) are unique; rows of other kinds, and rows without a
place, do nothing and are left out; an empty log gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from docloom.session import Staged

CHANGE, UNDO, SAVE = "change", "undo", "save"
RANGE_ROWS = 200_000
#: Events: ``undone_by`` is the undo's place where the range knows it; ``level`` numbers from 0 the changes that stand at the range's end
#: and are not saved, and the undos that found nothing. Summaries (``pops`` is not null) reduce a range.
_MATCHED = "part int, seq long, level long, is_undo boolean, undone_by long, pops long, saved boolean, stands long"
#: Undos number ``pop``, ``pop`` + 1, ... of a range take back changes ``level``, ``level`` - 1, ... of another, ``n`` in all.
_PIECES = "part int, level long, by_part int, pop long, n long"


def _match(ordered: DataFrame) -> DataFrame:
    """Rows of ``_MATCHED`` from (seq, kind) in ranges in order."""
    arrow = to_arrow_schema(StructType.fromDDL(_MATCHED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, stack, pops, saved, seen = TaskContext.get().partitionId(), [], [], False, False
        done: list[tuple] = []
        for batch in batches:
            for seq, kind in zip(batch.column("seq").to_pylist(), batch.column("kind").to_pylist()):
                seen = True
                if kind == CHANGE:
                    stack.append(seq)
                elif kind == SAVE:
                    done += [(part, s, None, False, None, None, None, None) for s in stack]
                    stack, saved = [], True
                elif stack:
                    done.append((part, stack.pop(), None, False, seq, None, None, None))
                elif not saved:
                    pops.append(seq)
        rows = [*done, *((part, s, k, False, None, None, None, None) for k, s in enumerate(stack)), *((part, s, k, True, None, None, None, None) for k, s in enumerate(pops))]
        if seen:
            rows.append((part, None, None, None, None, len(pops), saved, len(stack)))
        yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(arrow), arrow)], schema=arrow)

    return ordered.mapInArrow(run, _MATCHED)


def _pieces(summaries: DataFrame) -> DataFrame:
    """Rows of ``_PIECES`` from (part, pops, saved, stands) in the order of parts, in one task: one row a range."""
    arrow = to_arrow_schema(StructType.fromDDL(_PIECES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[list[int]] = []  # [part, changes that stand]
        rows: list[tuple] = []
        for row in (r for b in batches for r in b.to_pylist()):
            pop = 0
            while pop < row["pops"] and stack:
                part, stands = stack[-1]
                n = min(stands, row["pops"] - pop)
                rows.append((part, stands - 1, row["part"], pop, n))
                pop += n
                stack[-1][1] -= n
                if not stack[-1][1]:
                    stack.pop()
            if row["saved"]:
                stack = []
            if row["stands"]:
                stack.append([row["part"], row["stands"]])
        yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(arrow), arrow)], schema=arrow)

    return summaries.mapInArrow(run, _PIECES)


def matched(log: DataFrame, seq: str = "seq", kind: str = "kind", ranges: int | None = None) -> DataFrame:
    """(seq, undone_by) of every change: the place of the undo that takes it back, null if it stands."""
    events = log.select(F.col(seq).cast("long").alias("seq"), F.col(kind).alias("kind")).where(F.col("seq").isNotNull() & F.col("kind").isin(CHANGE, UNDO, SAVE))
    held = Staged(events, "undo-log").df
    ranges = ranges or max(1, -(-held.count() // RANGE_ROWS))
    found = Staged(_match(held.repartitionByRange(ranges, "seq").sortWithinPartitions("seq")), "undo-matched").df
    summaries = found.where("pops is not null").select("part", "pops", "saved", "stands")
    pieces = _pieces(summaries.repartition(1).sortWithinPartitions("part"))
    # Each undo of a piece by the range and level of its change; ranges of levels have no more entries than undos.
    undos = found.where("is_undo").select(F.col("part").alias("by_part"), F.col("level").alias("pop"), F.col("seq").alias("by"))
    parts = pieces.select("part", "by_part", F.posexplode(F.sequence(F.col("level"), F.col("level") - F.col("n") + 1, F.lit(-1).cast("long"))).alias("k", "level"), F.col("pop").alias("first"))
    later = parts.select("part", "level", "by_part", (F.col("first") + F.col("k")).alias("pop")).join(undos, ["by_part", "pop"]).select("part", "level", "by")
    changes = found.where("pops is null and not is_undo")
    across = changes.join(later, ["part", "level"], "left")
    return across.select("seq", F.coalesce("undone_by", "by").alias("undone_by"))


def standing(log: DataFrame, ranges: int | None = None) -> DataFrame:
    """item, seq, old, new of the changes (seq, kind, item, old, new) that no undo takes back."""
    kept = matched(log, ranges=ranges).where("undone_by is null").select("seq")
    return log.where(F.col("kind") == CHANGE).join(kept, "seq").select("item", "seq", "old", "new")


def statuses(log: DataFrame, ranges: int | None = None) -> DataFrame:
    """item, status of every item that was ever changed: what its last standing change left, or, if none stands, what it had before the
    first one (null: none)."""
    changes = log.where((F.col("kind") == CHANGE) & F.col("seq").isNotNull()).select("seq", "item", "old", "new").join(matched(log, ranges=ranges), "seq")
    held = changes.groupBy("item").agg(F.min_by(F.struct("old"), "seq").alias("first"), F.max_by(F.struct("new"), F.when(F.col("undone_by").isNull(), F.col("seq"))).alias("last"))
    return held.select("item", F.when(F.col("last").isNotNull(), F.col("last.new")).otherwise(F.col("first.old")).alias("status"))
