"""Census, targets, prices, shares and apportionment."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: What a unit of class 4 and of class 3 counts, what a machine's count weighs, the least share of a
#: partition, the weight of a price's own evidence, the share of a new price, the cap of dry minutes, the default price.
FULL, PART, MACHINE, FLOOR, ALPHA, EMA, CAP, SEED = 1.0, 0.1, 0.2, 0.05, 0.9, 0.15, 25.0, 3.0


def currency(cls: Column) -> Column:
    return F.when(cls == 4, FULL).when(cls == 3, PART).otherwise(0.0)


def census(rows: DataFrame, registry: DataFrame, part: str, cls: str) -> DataFrame:
    """Count of each class 1..4 and currency per partition; partitions without rows appear with zeros."""
    counts = [F.count_if(F.col(cls) == k).alias(f"n{k}") for k in (1, 2, 3, 4)]
    got = rows.groupBy(part).agg(*counts, F.sum(currency(F.col(cls))).alias("currency"))
    names = [f"n{k}" for k in (1, 2, 3, 4)]
    return registry.select(part).distinct().join(got, part, "left").select(part, *[F.coalesce(c, F.lit(0)).alias(c) for c in names], F.coalesce("currency", F.lit(0.0)).alias("currency"))


def deficits(stock: DataFrame, ratio: DataFrame, part: str) -> DataFrame:
    """Target of each partition, the largest stock scaled by its ratio to the largest ratio, and what is missing."""
    every = Window.partitionBy()
    both = stock.join(ratio, part)
    target = F.max("stock").over(every) * F.col("ratio") / F.max("ratio").over(every)
    return both.withColumn("target", target).withColumn("deficit", F.greatest(F.lit(0.0), F.col("target") - F.col("stock")))


def measured_prices(spent: DataFrame, part: str) -> DataFrame:
    """Minutes per unit, to three digits; the default where there is less than one unit to go by."""
    thin = F.col("units") < 1.0
    return spent.select(part, F.when(thin, SEED).otherwise(F.bround(F.col("minutes") / F.col("units"), 3)).alias("price"), thin.alias("defaulted"))


def shrunk(prices: DataFrame, part: str) -> DataFrame:
    """Measured prices drawn to their median by a geometric mean; defaulted ones stay."""
    middle = prices.where("not defaulted").agg(F.median("price").alias("_m"))
    kept = F.exp(ALPHA * F.ln("price") + (1 - ALPHA) * F.ln("_m"))
    return prices.crossJoin(F.broadcast(middle)).select(part, F.when(F.col("defaulted"), F.col("price")).otherwise(kept).alias("price"))  # one row


def spread_ratio(prices: DataFrame, price: str) -> DataFrame:
    """Dearest over cheapest; infinite where the cheapest is free."""
    low = F.min(price)
    return prices.agg(F.when(low > 0, F.max(price) / low).otherwise(F.lit(float("inf"))).alias("ratio"))


def clamped_price(price: Column, seed: Column, clamp: float = 4.0) -> Column:
    return F.greatest(F.least(price, seed * clamp), seed / clamp)


def sample_weight(batches: Column, share: float = EMA) -> Column:
    """What an exponential mean of so many steps owes to them and not to its start."""
    return 1 - F.pow(F.lit(1 - share), batches)


def ema_ratio(steps: DataFrame, part: str, order: str, minutes: str, units: str, share: float = EMA, least: float = 1e-6) -> DataFrame:
    """Price per partition as the ratio of two exponential means, of minutes and of units, one step per charged batch."""
    folded = steps.groupBy(part).agg(F.array_sort(F.collect_list(F.struct(order, minutes, units))).alias("s"))
    mean = lambda c: F.aggregate("s", F.lit(0.0), lambda a, x: a * (1 - share) + x[c] * share)
    return folded.select(part, F.size("s").alias("steps"), (mean(minutes) / F.greatest(mean(units), F.lit(least))).alias("price"))


def incomplete(mix: DataFrame, registry: DataFrame, part: str, ratio: str) -> DataFrame:
    """Partitions that the mix or the registry lacks, or whose ratio isn't positive; none if both cover each other."""
    both = registry.select(part).distinct().withColumn("_r", F.lit(True)).join(mix.select(part, ratio).withColumn("_m", F.lit(True)), part, "full")
    why = F.when(F.col("_m").isNull(), "missing").when(F.col("_r").isNull(), "unregistered").when(~(F.coalesce(F.col(ratio), F.lit(0)) > 0), "not_positive")
    return both.select(part, why.alias("why")).where("why is not null")


def unspent_floor(spent: DataFrame, part: str, total: Column, floor: float = FLOOR, alarm: float = 0.9) -> DataFrame:
    """Of ``(part, spent, servable)`` minutes: what share of the promised floor was not used, and why."""
    promised = floor * total
    unused = F.when(promised > 0, 1 - F.col("spent") / promised)
    state = F.when(F.col("servable") <= 0, "starved").when(unused >= alarm, "unspent").otherwise("spent")
    return spent.select(part, F.greatest(unused, F.lit(0.0)).alias("unspent"), state.alias("state"))


def realised_mix(steps: DataFrame, part: str, measures: list[str], intents: DataFrame) -> DataFrame:
    """Share of each measure per partition against the intended share; partitions without rows have zeros."""
    got = steps.groupBy(part).agg(*[F.sum(m).alias(m) for m in measures])
    both = intents.select(part, "intent").join(got, part, "left")
    every = Window.partitionBy()
    share = lambda m: F.coalesce(F.col(m) / F.nullif(F.sum(m).over(every), F.lit(0)), F.lit(0.0))
    return both.select(part, "intent", *[share(m).alias(f"{m}_share") for m in measures], (F.col("intent") - share(measures[0])).alias("gap"))


def ema(steps: DataFrame, part: str, order: str, value: str, share: float = EMA) -> DataFrame:
    """Exponential mean of ``value`` per partition in ``order``: the first value, then a step of ``share`` each."""
    folded = steps.groupBy(part).agg(F.array_sort(F.collect_list(F.struct(order, value))).alias("s"))
    start = F.get("s", F.lit(0))[value].cast("double")
    rest = F.slice("s", 2, F.greatest(F.size("s") - 1, F.lit(0)))
    return folded.select(part, F.aggregate(rest, start, lambda a, x: a * (1 - share) + x[value] * share).alias("ema"), F.size("s").alias("steps"))


def water_fill(weights: DataFrame, part: str, weight: str, floor: float = FLOOR, external: Column | None = None) -> DataFrame:
    """Shares that sum to 1, none under ``floor``, the rest in proportion to the weights; even if all weights are 0.

    Partitions that ``external`` says are served elsewhere get 0 and count for nothing. ``floored`` tells the shares
    that the floor set: in an even split only where an even share is under the floor, or the floors are too many.
    Closed form: in order of weight, the partitions from some place on share what the floors before them leave; the
    first place whose share reaches the floor is the cut. One row per partition, of which there is a handful.
    """
    out = F.coalesce(external, F.lit(False)) if external is not None else F.lit(False)
    s = weights.withColumn("_out", out)
    up = Window.partitionBy("_out").orderBy(weight, part)
    rest = up.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy("_out")
    s = s.withColumn("_w", F.greatest(F.col(weight).cast("double"), F.lit(0.0)))
    s = s.withColumn("_i", F.row_number().over(up) - 1).withColumn("_n", F.count("*").over(every)).withColumn("_rest", F.sum("_w").over(rest)).withColumn("_all", F.sum("_w").over(every))
    scale = (1 - F.col("_i") * floor) / F.col("_rest")
    s = s.withColumn("_scale", F.when(F.col("_rest") > 0, scale)).withColumn("_ok", F.col("_scale") * F.col("_w") >= floor - 1e-12)
    cut = F.min(F.when(F.col("_ok"), F.col("_i"))).over(every)
    s = s.withColumn("_cut", cut)
    used = F.max(F.when(F.col("_i") == F.col("_cut"), F.col("_scale"))).over(every)
    crowded = F.col("_n") * floor >= 1
    even = (F.col("_all") <= 0) | crowded
    share = F.when(F.col("_out"), 0.0).when(even, 1.0 / F.col("_n")).when(F.col("_i") < F.col("_cut"), F.lit(floor)).otherwise(used * F.col("_w"))
    floored = F.when(F.col("_out"), False).when(crowded, True).when(F.col("_all") <= 0, 1.0 / F.col("_n") < floor).otherwise(F.col("_i") < F.col("_cut"))
    return s.select(part, weight, share.alias("share"), floored.alias("floored"))


def largest_deficit(weights: dict[str, float], n: int, caps: dict[str, int] | None = None) -> list[str]:
    """The sequence of ``n`` picks that stays closest to the weights: each goes to the partition furthest behind its
    share of all weights, ties to the heavier, then to the greater name.

    Given caps, a partition at its cap drops out, one that they don't name has none to give; shares stay those of all
    weights. No weight, no picks. A handful of partitions, so a loop on the driver.
    """
    taken, out = dict.fromkeys(weights, 0), []
    total = sum(max(0.0, w) for w in weights.values())
    room = {k: math.inf if caps is None else caps.get(k, 0) for k in weights}
    for place in range(1, n + 1):
        live = [k for k, w in weights.items() if w > 0 and taken[k] < room[k]]
        if not live:
            break
        pick = max(live, key=lambda k: (place * weights[k] / total - taken[k], weights[k], k))
        taken[pick] += 1
        out.append(pick)
    return out


def guaranteed_slots(weights: dict[str, float], n: int, caps: dict[str, int] | None = None, guaranteed=()) -> dict[str, int]:
    """Slots by largest deficit, with at least one for each guaranteed partition that has weight and room.

    A guarantee is a floor: partitions that the rule leaves empty are pinned at one, the rest is dealt anew, until
    none is left out. More guarantees than slots is an error; a name without weight or room is none.
    """
    n = max(0, n)
    able = [k for k, w in weights.items() if w > 0 and (caps is None or caps.get(k, 0) > 0)]
    owed = [k for k in able if k in set(guaranteed)]
    if len(owed) > n:
        raise ValueError(f"{len(owed)} guarantees for {n} slots")
    pinned: set[str] = set()
    while True:
        free = {k: weights[k] for k in able if k not in pinned}
        got = dict.fromkeys(weights, 0) | dict.fromkeys(pinned, 1)
        for k in largest_deficit(free, n - len(pinned), None if caps is None else {k: caps[k] for k in free}):
            got[k] += 1
        left_out = [k for k in owed if not got[k]]
        if not left_out or not n:
            return got
        pinned.update(left_out)


def truncated(want: dict[str, int], budget: int) -> dict[str, int]:
    """``want`` if it fits into ``budget``; else as many as fit, in proportion, by largest deficit."""
    if sum(want.values()) <= budget:
        return dict(want)
    got = dict.fromkeys(want, 0)
    for k in largest_deficit({k: float(v) for k, v in sorted(want.items())}, max(0, budget)):
        got[k] += 1
    return got


def share_gaps(intended: dict[str, float], spent: dict[str, float], servable) -> dict[str, float]:
    """What each servable partition's share of the minutes lacks of the intended one; before any minute, all of it."""
    total = sum(max(0.0, v) for v in spent.values())
    return {k: intended.get(k, 0.0) - (spent.get(k, 0.0) / total if total > 0 else 0.0) for k in servable}


def batch_slots(intended: dict[str, float], spent: dict[str, float], queues: dict[str, int], n: int, claimants=(), capped=(), per_slot: dict[str, float] | None = None) -> tuple[dict[str, int], str]:
    """Slots of a batch, and what they were weighed by: share gaps over minutes per slot; where no partition is
    behind, intents; where there are none, one each. A queue bounds what it can take, a capped partition takes
    nothing, and the first claimants, as many as there are slots, get one at least."""
    servable = {k: q for k, q in queues.items() if q > 0 and k not in set(capped)}
    cost = {k: max(1e-9, (per_slot or {}).get(k, 1.0)) for k in servable}
    offers = [("share_gap", share_gaps(intended, spent, servable)), ("intent", {k: intended.get(k, 0.0) for k in servable}), ("even", dict.fromkeys(servable, 1.0))]
    for source, offer in offers:
        weights = {k: max(0.0, v) / cost[k] for k, v in offer.items()}
        if sum(weights.values()) > 0:
            break
    due = [k for k in claimants if k in servable][:n]
    return dict.fromkeys(queues, 0) | guaranteed_slots(weights, n, servable, due), source


def head_split(n: int, share: float) -> dict[str, int]:
    """``n`` slots on the two heads; the second one's share is rounded half to even."""
    second = max(0, min(n, round(n * share)))
    return {"first": n - second, "second": second}


def guarantee_heads(owed, slots: dict[str, int]) -> tuple[dict[str, str], list[str]]:
    """Which head pays each owed partition, in order of name: the one that paid least so far and has room, then by
    name; and those no head has room for."""
    paid, left, placed = {}, [], dict.fromkeys(slots, 0)
    for k in sorted(set(owed)):
        room = [h for h in slots if placed[h] < slots[h]]
        if room:
            paid[k] = min(room, key=lambda h: (placed[h], h))
            placed[paid[k]] += 1
        else:
            left.append(k)
    return paid, left


def attempt_cells(supply: dict[str, int], mix: dict[str, float], n: int, share: float, budget: int | None = None, guarantees=(), multiple: int = 4) -> list[tuple[str, str, int]]:
    """``(head, partition, rank)`` in order: each head's slots are dealt by the mix over what has supply, each slot is
    worth ``multiple`` attempts, cut to the budget in proportion and to the supply; cells interleave by largest
    deficit, and each takes its ranked offer from the top."""
    slots = head_split(n, share)
    want = {h: multiple * k for h, k in slots.items()}
    granted = want if budget is None else truncated(want, budget)
    able = {k: q for k, q in sorted(supply.items()) if q > 0}
    paid, _ = guarantee_heads([k for k in guarantees if k in able], slots)
    whole = sum(mix[k] for k in able)
    cells = {}
    for head in slots:
        seats = guaranteed_slots({k: mix[k] / whole for k in able}, slots[head], None, [k for k, h in paid.items() if h == head])
        tries = truncated({k: multiple * v for k, v in sorted(seats.items())}, granted[head])
        cells |= {(head, k): min(v, able[k]) for k, v in sorted(tries.items()) if min(v, able[k]) > 0}
    taken, out = dict.fromkeys(cells, 0), []
    for cell in largest_deficit({c: float(v) for c, v in sorted(cells.items())}, sum(cells.values())):  # type: ignore[misc]
        out.append((*cell, taken[cell]))
        taken[cell] += 1
    return out


def even_capped(supply: DataFrame, part: str, cap: str, budget: int) -> DataFrame:
    """Even shares of ``budget`` under each partition's cap; what a cap leaves is offered again, remainders by name."""
    up = Window.partitionBy().orderBy(cap, part)
    every = Window.partitionBy()
    s = supply.withColumn("_i", F.row_number().over(up) - 1).withColumn("_n", F.count("*").over(every))
    before = F.coalesce(F.sum(cap).over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    s = s.withColumn("_left", F.lit(budget) - before).withColumn("_level", F.floor(F.greatest(F.lit(0), F.col("_left")) / (F.col("_n") - F.col("_i"))))
    s = s.withColumn("_free", F.col(cap) > F.col("_level"))
    first = F.min(F.when(F.col("_free"), F.col("_i"))).over(every)
    s = s.withColumn("_first", first)
    level = F.max(F.when(F.col("_i") == F.col("_first"), F.col("_level"))).over(every)
    left = F.max(F.when(F.col("_i") == F.col("_first"), F.col("_left"))).over(every)
    open_ = F.col("_first").isNotNull() & (F.col("_i") >= F.col("_first"))
    s = s.withColumn("_base", F.when(open_, level).otherwise(F.col(cap))).withColumn("_extra", F.when(open_, left - level * (F.col("_n") - F.col("_first"))).otherwise(0)).withColumn("_open", open_)
    named = Window.partitionBy("_open").orderBy(part)
    bonus = F.when(F.col("_open") & (F.row_number().over(named) <= F.col("_extra")), 1).otherwise(0)
    return s.select(part, cap, (F.col("_base") + bonus).cast("long").alias("slots"))


def thin_cap(passing: Column, divisor: int = 4) -> Column:
    return F.floor(passing / divisor)


def mix_shares(mix: DataFrame, part: str) -> DataFrame:
    return mix.withColumn("share", F.col("ratio") / F.sum("ratio").over(Window.partitionBy()))


def effective_intent(steps: DataFrame, part: str) -> DataFrame:
    """Mean intent weighted by minutes; the plain mean where no minute was spent."""
    got = steps.groupBy(part).agg(F.sum(F.col("intent") * F.col("minutes")).alias("w"), F.sum("minutes").alias("m"), F.avg("intent").alias("plain"))
    return got.select(part, F.when(F.col("m") > 0, F.col("w") / F.col("m")).otherwise(F.col("plain")).alias("intent"))


def minutes_per_slot(served: DataFrame, part: str) -> DataFrame:
    """Minutes per slot; a partition without slots takes the pooled ratio, 1 where nothing was served."""
    every = Window.partitionBy()
    pooled = F.when(F.sum("slots").over(every) > 0, F.sum("minutes").over(every) / F.sum("slots").over(every)).otherwise(1.0)
    return served.select(part, F.when(F.col("slots") > 0, F.col("minutes") / F.col("slots")).otherwise(pooled).alias("per_slot"))
