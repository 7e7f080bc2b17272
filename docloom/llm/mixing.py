"""Mixing sources to target weights by hierarchical budgeting.

Sources hang in a tree (by default domain, language, source). A token budget flows from the root: each
node shares its budget among its children by weight, no child gets more than its subtree can give in
``max_epochs`` passes, and what a child can't use goes to its siblings first; only what no sibling can use
is left for the level above. From each leaf come whole epochs and then, in an order seeded per epoch, the
longest run of documents that fits the rest of its budget.

All of it is joins and windows over sums. A level's windows hold one row per child, never documents. The
cut within a leaf is found in two steps, from sums by hash range and then within the one range where the
budget ends, so a leaf with most of the rows is never sorted as a whole.

Defined results: null level values form a node of their own (written as empty text); documents without
tokens cost nothing and come with every full or partial pass that reaches their place; rows with the same
id (or with none) are taken or left together; very long texts are counted whole; an empty table gives no rows. Weights
not given count as 1; a node of weight 0 gets nothing. Columns of the input keep their names through ``repeat_rows``,
also those that begin with mix_ or own_.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.session import Staged

#: Hash ranges a leaf at least; with more rows the square root of their number, so that neither the ranges of a leaf
#: nor the rows of its one cut range outgrow a task.
RANGES = 4096
BROADCAST_LEAVES = 20_000
TOKEN = r"[^ \t\n\r\f]+"
_OWN = re.compile("(?:own_)*mix_")


def n_tokens(text: Column) -> Column:
    """Tokens as the budget counts them: runs between white space."""
    return F.coalesce(F.regexp_count(text, F.lit(TOKEN)), F.lit(0)).cast("long")


def order_key(doc_id: Column, seed: int, epoch: Column) -> Column:
    """The place of a document in the pass: 32 hex digits."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def _weight(level: str, weights: dict[str, int]) -> Column:
    out = F.lit(1)
    for value, weight in sorted(weights.items()):
        out = F.when(F.col(level) == value, F.lit(int(weight))).otherwise(out)
    return out.cast("long")


def _share(children: DataFrame, parent: Sequence[str]) -> DataFrame:
    """Fill ``budget`` (of the parent) into children with columns weight and capacity, as water over steps.

    Children in order of capacity per weight: the first few are full; the rest share what is left by weight.
    Child i is full if the level reached when the smaller ones are full is at least its own.
    """
    by = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    ranked = by.orderBy(F.col("capacity") / F.col("weight"), "child")
    upto, after = ranked.rowsBetween(Window.unboundedPreceding, -1), ranked.rowsBetween(0, Window.unboundedFollowing)
    used = F.coalesce(F.sum("capacity").over(upto), F.lit(0))
    rest = F.sum("weight").over(after)
    level = (F.col("budget") - used).cast("double") / rest
    filled = children.where("weight > 0").withColumn("level", level)
    # Levels rise up to the first child that is not full and fall after it; that child's level holds for all later ones.
    filled = filled.withColumn("water", F.max(F.when(F.col("level") < F.col("capacity") / F.col("weight"), F.col("level"))).over(by))
    got = F.when(F.col("water").isNull() | (F.col("capacity") / F.col("weight") <= F.col("water")), F.col("capacity")).otherwise(F.floor(F.greatest(F.col("water"), F.lit(0.0)) * F.col("weight")))
    return filled.withColumn("budget", F.least(got.cast("long"), F.col("capacity"))).drop("level", "water")


def leaf_budgets(leaves: DataFrame, levels: Sequence[str], weights: dict[str, dict[str, int]], total: Column, max_epochs: int) -> DataFrame:
    """levels, supply, budget of each leaf, from rows (levels..., supply). ``total`` is an aggregate over leaves."""
    cap = leaves.withColumn("capacity", F.col("supply") * max_epochs)
    nodes = cap.agg(F.coalesce(total.cast("long"), F.lit(0)).alias("budget"), F.coalesce(F.sum("capacity"), F.lit(0)).alias("capacity")).select(F.least("budget", "capacity").alias("budget"))
    path: list[str] = []
    for level in levels:
        children = cap.groupBy(*path, level).agg(F.sum("capacity").alias("capacity")).withColumn("weight", _weight(level, weights.get(level, {}))).withColumn("child", F.col(level))
        children = children.join(nodes, path) if path else children.join(F.broadcast(nodes))  # the root is one row
        nodes = _share(children, path).select(*path, level, "budget")
        path.append(level)
    return nodes.join(leaves, list(levels)).select(*levels, "supply", "budget", *[c for c in leaves.columns if c == "rows"])


def plan(docs: DataFrame, levels: Sequence[str], weights: dict[str, dict[str, int]], fraction: tuple[int, int], max_epochs: int, seed: int, ranges: int | None = None) -> DataFrame:
    """One row per leaf: levels, supply, budget, full (whole epochs), last_key (the last document's key in the
    partial pass, null if none). ``docs`` has doc_id, n_tokens and the levels."""
    leaves = docs.groupBy(*levels).agg(F.sum("n_tokens").alias("supply"), F.count("*").alias("rows"))
    total = F.floor(F.sum("supply") * fraction[0] / fraction[1])
    budgets = leaf_budgets(leaves, levels, weights, total, max_epochs)
    full = F.when(F.col("supply") > 0, F.floor(F.col("budget") / F.col("supply"))).otherwise(0).cast("long")
    budgets = budgets.withColumn("full", full).withColumn("rest", F.col("budget") - F.col("full") * F.col("supply"))
    budgets = Staged(budgets, "mix-budgets").df  # one row a leaf
    ranges = ranges or max(RANGES, math.isqrt(budgets.agg(F.coalesce(F.max("rows"), F.lit(0))).first()[0]))
    part = F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * ranges / F.lit(1 << 32)
    salted = docs.withColumn("salt", F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 64)
    passes = budgets.select(*levels, "full", "rest").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(63)).cast("array<bigint>")))
    keyed = salted.join(passes, [*levels, "salt"]).withColumn("key", order_key(F.col("doc_id"), seed, F.col("full"))).withColumn("part", F.floor(part).cast("int"))
    keyed = Staged(keyed.select(*levels, "doc_id", "n_tokens", "key", "part", "rest"), "mix-keys").df
    sums = keyed.groupBy(*levels, "part").agg(F.sum("n_tokens").alias("tokens"), F.max("key").alias("top"), F.first("rest").alias("rest"))
    before = Window.partitionBy(*levels).orderBy("part")
    sums = sums.withColumn("until", F.sum("tokens").over(before))
    whole = sums.where("until <= rest").groupBy(*levels).agg(F.max("top").alias("whole_key"))
    cut = sums.where("until > rest").groupBy(*levels).agg(F.min_by(F.struct("part", (F.col("until") - F.col("tokens")).alias("done")), "part").alias("cut")).select(*levels, "cut.part", "cut.done")
    inside = keyed.join(cut, [*levels, "part"])
    running = F.col("done") + F.sum("n_tokens").over(Window.partitionBy(*levels, "part").orderBy("key"))  # rows of one id together
    partial = inside.withColumn("run", running).where("run <= rest").groupBy(*levels).agg(F.max("key").alias("part_key"))
    out = budgets.join(whole, list(levels), "left").join(partial, list(levels), "left")
    return out.withColumn("last_key", F.when(F.col("rest") > 0, F.coalesce("part_key", "whole_key"))).select(*levels, "supply", "budget", "full", "last_key")


def select(df: DataFrame, level_columns: dict[str, Column], weights: dict[str, dict[str, int]], fraction: tuple[int, int] = (1, 2), max_epochs: int = 4, seed: int = 17, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with columns mix_tokens, mix_budget, mix_copies (how often a row is taken, at least once) and
    the levels as mix_<level>; rows that are not taken are left out. The texts are not shuffled as long as
    the leaves number at most ``BROADCAST_LEAVES``. Columns of ``df`` named mix_..., own_mix_... and so on get one more
    own_ before their names."""
    levels = [f"mix_{name}" for name in level_columns]
    df = df.toDF(*[f"own_{c}" if _OWN.match(c) else c for c in df.columns])
    placed = df.withColumns({f"mix_{name}": F.coalesce(c.cast("string"), F.lit("")) for name, c in level_columns.items()} | {"mix_tokens": n_tokens(F.col(text_col))})
    sizes = Staged(placed.select(F.col(id_col).cast("long").alias("doc_id"), F.col("mix_tokens").alias("n_tokens"), *levels), "mix-sizes")
    leaves = Staged(plan(sizes.df, levels, {f"mix_{k}": v for k, v in weights.items()}, fraction, max_epochs, seed), "mix-leaves").df
    leaves = leaves.select(*levels, F.col("budget").alias("mix_budget"), F.col("full").alias("mix_full"), "last_key")
    few = leaves.limit(BROADCAST_LEAVES + 1).count() <= BROADCAST_LEAVES
    joined = placed.join(F.broadcast(leaves) if few else leaves, levels)
    extra = F.when(order_key(F.col(id_col).cast("long"), seed, F.col("mix_full")) <= F.col("last_key"), 1).otherwise(0)
    return joined.withColumn("mix_copies", F.col("mix_full") + extra).where("mix_copies > 0").drop("mix_full", "last_key")


def repeat_rows(selected: DataFrame) -> DataFrame:
    """Each row as often as it is taken, without the columns that ``select`` added and under the input's names."""
    copies = selected.withColumn("mix_pass", F.explode(F.sequence(F.lit(1), F.col("mix_copies").cast("int"))))
    plain = copies.drop(*[c for c in copies.columns if c.startswith("mix_")])
    return plain.toDF(*[c.removeprefix("own_") if _OWN.match(c) else c for c in plain.columns])
