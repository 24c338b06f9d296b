"""Frontiers, spacing and placement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.select import hashed


def batch_pop(frontier: DataFrame, priority: str, key: str, floors: dict[str, int], size: int) -> DataFrame:
    """``size`` nodes: first those that reserved floors, conditions with a least number, pick by priority, then the best
    of the rest."""
    whole = F.struct(*frontier.columns)
    best = [F.desc(priority), F.col(key)]
    picked = frontier.orderBy(*best).limit(size).select(whole.alias("_r"), F.lit(False).alias("_reserved"))
    for condition, least in floors.items():
        picked = picked.unionByName(frontier.where(condition).orderBy(*best).limit(least).select(whole.alias("_r"), F.lit(True).alias("_reserved")))
    once = picked.groupBy("_r").agg(F.some("_reserved").alias("_reserved")).select("_r.*", "_reserved")
    # At most ``size`` and the floors' rows are left to number.
    place = F.row_number().over(Window.partitionBy().orderBy(F.desc("_reserved"), *best))
    return once.withColumn("place", place).where(F.col("place") <= size).drop("_reserved")


def evicted(frontier: DataFrame, expansions: DataFrame, root: str, cap: int) -> DataFrame:
    """Nodes whose root is still below its cap of expansions."""
    spent = expansions.groupBy(root).agg(F.count("*").alias("_n")).where(F.col("_n") >= cap)
    return frontier.join(spent, root, "left_anti")


def governed(rolls: DataFrame, cell: list[str], order: str, chance: float, seed: int) -> DataFrame:
    """The first roll of each cell whose keyed coin falls; a cell fires once, and rolls before that leave no trace."""
    coin = F.conv(F.substring(hashed(seed, *cell, order), 1, 12), 16, 10).cast("double") / float(1 << 48)
    fired = rolls.where(coin < chance)
    whole = F.struct(*rolls.columns)
    return fired.groupBy(*cell).agg(F.min_by(whole, F.col(order)).alias("_r")).select("_r.*")


def memory_discount(priority: Column, score: Column, density: Column, strength: float = 1.0) -> Column:
    return priority + (1 / (1 + strength * density) - 1) * score


def prefix_deviation(sequence: DataFrame, order: str, part: str, shares: DataFrame) -> DataFrame:
    """How far a sequence's counts ever stray from the shares: the largest difference over all prefixes."""
    every = sequence.select(F.col(order).alias("_at"), F.col(part).alias("_got"))
    grid = every.join(F.broadcast(shares.select(part, "share")))  # a handful of partitions
    w = Window.partitionBy(part).orderBy("_at")
    counted = grid.withColumn("_n", F.sum((F.col("_got") == F.col(part)).cast("long")).over(w)).withColumn("_i", F.row_number().over(w))
    return counted.groupBy(part).agg(F.max(F.abs(F.col("_n") - F.col("_i") * F.col("share"))).alias("deviation"))
