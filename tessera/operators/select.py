"""Ranking and selection under caps, draws, splits and weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hashed(seed: int, *key: str) -> Column:
    """A place in a shuffled order that is the same on every cluster."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key]))


def placed(rows: DataFrame, coarse: Column, order: list) -> DataFrame:
    """``rows`` with ``place``, their number from 1 in the order of ``coarse`` and then of ``order``.

    No task sees all rows: those of one coarse value are numbered among themselves, and only the counts of the coarse
    values are summed up in order. ``coarse`` is never null and has few values, or few rows each.
    """
    cut = rows.withColumn("_c", coarse)
    before = F.coalesce(F.sum("_n").over(Window.partitionBy().orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offset = cut.groupBy("_c").agg(F.count("*").alias("_n")).withColumn("_before", before).select("_c", "_before")
    own = F.row_number().over(Window.partitionBy("_c").orderBy(*order))
    return cut.join(offset, "_c").withColumn("place", (F.col("_before") + own).cast("int")).drop("_c", "_before")


def best_first_by(part: str, score: str, keys: list[str]) -> Column:
    """Place from 1 by falling score; a null one counts as -1."""
    return F.row_number().over(Window.partitionBy(part).orderBy(F.coalesce(score, F.lit(-1.0)).desc(), *keys))


def entries(rows: DataFrame, number: str, part: str, group: str, score: str) -> DataFrame:
    """Scored rows as the selection reads them: ``(id, part, group, score)``; the id is the number in four digits at
    least, and a row without a group is a group of its own."""
    own = F.coalesce(F.concat(F.lit("group#"), F.col(group).cast("string")), F.concat(F.lit("unplaced#"), F.col(number).cast("string")))
    return rows.where(F.col(score).isNotNull()).select(F.format_string("%04d", F.col(number).cast("long")).alias("id"), F.col(part).alias("part"), own.alias("group"), F.col(score).cast("double").alias("score"))


def budgeted(slots: DataFrame) -> DataFrame:
    """``(part, slots, cap, guaranteed)`` with ``budget``: slots under the cap (null: none), one at least where a slot is
    guaranteed."""
    plain = F.least(F.col("slots"), F.coalesce("cap", F.col("slots")))
    owed = F.coalesce("guaranteed", F.lit(False)) & (F.col("slots") >= 1)
    return slots.withColumn("owed", owed).withColumn("budget", F.when(owed, F.greatest(plain, F.lit(1))).otherwise(plain))


def release(candidates: DataFrame, slots: DataFrame, cluster_cap: int = 2, bar: float | None = None, used: DataFrame | None = None) -> DataFrame:
    """The log of a release: every row looked at, best first per partition, until the partition's budget is picked.

    ``candidates(id, part, group, score)``, ``slots(part, slots, cap, guaranteed)``; a partition without slots gives
    nothing. Rows below ``bar`` are skipped, and so are those whose group has ``cluster_cap`` picks; ``used(group, n)``
    are picks of earlier passes. A group lies within one partition (grouping embeds the plane), so taking greedily is,
    group by group, keeping the first few over the bar, then the first of those. Ties by id.
    """
    order = [F.desc("score"), "id"]
    by = Window.partitionBy("part").orderBy(*order)
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    rows = candidates.join(F.broadcast(budgeted(slots).select("part", "slots", "cap", "owed", "budget")), "part")  # a row per partition
    rows = rows.join(used.select("group", F.col("n").alias("_used")), "group", "left") if used is not None else rows.withColumn("_used", F.lit(0))
    good = F.lit(True) if bar is None else F.coalesce(F.col("score") >= bar, F.lit(False))
    rows = rows.withColumn("_used", F.coalesce("_used", F.lit(0))).withColumn("_good", good).withColumn("rank", F.row_number().over(by) - 1)
    count = F.sum(F.col("_good").cast("int")).over(Window.partitionBy("part", "group").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("group_count", F.col("_used") + count).withColumn("_ok", F.col("_good") & (F.col("group_count") <= cluster_cap))
    rows = rows.withColumn("_taken", F.coalesce(F.sum(F.col("_ok").cast("int")).over(before), F.lit(0))).where("_taken < budget")
    skipped = F.when(~F.col("_good"), "below_bar").when(~F.col("_ok"), "cluster_cap")
    source = F.when(F.col("_ok"), F.when(F.col("owed") & (F.col("_taken") == 0), "guarantee").otherwise("mix"))
    return rows.select("id", "part", "group", "rank", "score", F.col("_ok").alias("picked"), skipped.alias("skipped"), source.alias("slot_source"), F.when(F.col("_ok"), F.col("group_count")).cast("long").alias("group_count"))


def fills(log: DataFrame, candidates: DataFrame, slots: DataFrame) -> DataFrame:
    """Per partition with slots: what was planned, seated and left, and why, the first cause that applies; null where
    nothing is left."""
    seen = log.groupBy("part").agg(F.count_if("picked").alias("seated"), F.count_if(F.col("skipped") == "below_bar").alias("below_bar"), F.count_if(F.col("skipped") == "cluster_cap").alias("cluster_cap"))
    eligible = candidates.groupBy("part").agg(F.count("*").alias("eligible"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    all_ = budgeted(slots).where("slots > 0").join(seen, "part", "left").join(eligible, "part", "left")
    all_ = all_.select("part", F.col("slots").cast("long").alias("planned"), F.col("budget").cast("long").alias("budget"), *map(zero, ("eligible", "seated", "below_bar", "cluster_cap")))
    return all_.withColumn("unfilled", F.greatest(F.col("planned") - F.col("seated"), F.lit(0))).withColumn("reason", fill_reason(*map(F.col, ("unfilled", "seated", "budget", "below_bar", "cluster_cap"))))


def served(rows: DataFrame, part: str, head: str, score: str, key: str) -> DataFrame:
    """Rows with ``verdict`` released, a ``picture``, and nothing in ``rejected``, in the order of ``interleaved``."""
    good = (F.col("verdict") == "released") & F.col("picture").isNotNull() & F.col("rejected").isNull()
    return interleaved(rows.where(good), part, head, score, key)


def interleaved(rows: DataFrame, part: str, head: str, score: str, key: str) -> DataFrame:
    """A listing that takes each cell's best, then each cell's second, and so on; null scores last."""
    cell = Window.partitionBy(part, head).orderBy(F.col(score).desc_nulls_last(), key)
    return placed(rows.withColumn("rank", F.row_number().over(cell)), F.col("rank"), [part, head, key])


def fill_reason(unfilled: Column, seated: Column, budget: Column, below_bar: Column, capped: Column) -> Column:
    """Why slots stay empty; null where none does."""
    short = F.when(below_bar > 0, "below_bar").when(capped > 0, "cluster_cap").otherwise("no_candidates")
    return F.when(unfilled > 0, F.when(seated < budget, short).otherwise("supply_cap"))


def stratified(rows: DataFrame, cells: list[str], key: str, n: int, seed: int) -> DataFrame:
    """``n`` rows dealt to the cells in turns, each cell in shuffled order; small cells give all, the rest is offered again."""
    own = Window.partitionBy(*cells).orderBy(hashed(seed, key), key)
    turn = rows.withColumn("_turn", F.row_number().over(own)).where(F.col("_turn") <= n)
    return placed(turn, F.col("_turn"), [*cells, key]).where(F.col("place") <= n).drop("_turn")


def group_split(rows: DataFrame, group: str, eligible: str, pinned: str, share: float, seed: int) -> DataFrame:
    """Groups for evaluation: pinned ones, then eligible ones whole, in shuffled order, until the share is reached."""
    g = rows.groupBy(group).agg(F.count("*").alias("n"), F.every(eligible).alias("ok"), F.some(pinned).alias("pin"))
    every = Window.partitionBy()
    order = every.orderBy(F.desc("pin"), hashed(seed, group), group)
    took = g.where("pin or ok").withColumn("before", F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    total = rows.agg(F.bround(F.count("*") * share).cast("long").alias("want"))
    picked = took.crossJoin(F.broadcast(total)).where("pin or before < want").select(group, F.lit("eval").alias("side"))  # one row
    return g.join(picked, group, "left").select(group, "n", F.coalesce("side", F.lit("train")).alias("side"))


def sampling_weights(rows: DataFrame, cls: str, group: str, biased: Column, beta: float) -> DataFrame:
    """One over the root of the class size, one over the group size, and ``beta`` for biased rows; shares in all."""
    by_class, by_group = rows.groupBy(cls).agg(F.count("*").alias("_c")), rows.groupBy(group).agg(F.count("*").alias("_g"))
    w = rows.join(by_class, cls).join(by_group, group).withColumn("weight", 1 / F.sqrt("_c") / F.col("_g") * F.when(biased, beta).otherwise(1.0))
    return w.drop("_c", "_g")


def numbered(rows: DataFrame, order: str, parts: int = 256) -> DataFrame:
    """``rows`` with ``place``, their number from 1 by a column of distinct numbers. Bounds of about equal shares, found
    first, part the order, so no task numbers all rows."""
    bounds = rows.approxQuantile(order, [k / parts for k in range(1, parts)], 0.001) if parts > 1 else []
    coarse = F.size(F.filter(F.array(*map(F.lit, sorted(set(bounds)))), lambda b: b < F.col(order))) if bounds else F.lit(0)
    return placed(rows, coarse, [order])


def two_to_one(first: DataFrame, second: DataFrame, order: str) -> DataFrame:
    """Two of ``first``, one of ``second``, in their orders (distinct numbers); what one has left follows."""
    both = numbered(first, order).withColumn("channel", F.lit(0)).unionByName(numbered(second, order).withColumn("channel", F.lit(1)))
    i = F.col("place") - 1
    turn = F.when(F.col("channel") == 0, F.floor(i / 2) * 3 + i % 2).otherwise(i * 3 + 2)
    both = both.withColumn("_i", i).withColumn("_turn", turn).drop("place")
    # Rows of one turn of three, and a thousand turns, are few: a task numbers one such run.
    return placed(both, F.floor(F.col("_turn") / 3072), ["_turn", "channel", "_i"]).drop("_i", "_turn")


def period_round_robin(rows: DataFrame, period: str, margin: str, key: str) -> DataFrame:
    own = Window.partitionBy(period).orderBy(F.desc(margin), key)
    return placed(rows.withColumn("rank", F.row_number().over(own)), F.col("rank"), [period, key])


def middle_run(rows: DataFrame, by: list[str], stat: str, key: str) -> DataFrame:
    w = Window.partitionBy(*by)
    s = rows.withColumn("_i", F.row_number().over(w.orderBy(stat, key))).withColumn("_n", F.count("*").over(w))
    return s.where(F.col("_i") == F.floor(F.col("_n") / 2) + 1).drop("_i", "_n")
