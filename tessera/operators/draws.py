"""Seeded draws, holdouts, plans, and points kept apart."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.scratch import Scratch
from tessera.operators.select import hashed, placed


def shuffled(rows: DataFrame, key: str, seed: int) -> DataFrame:
    """``rows`` with ``place`` in a seeded order that is the same on every cluster.

    The first hex digits of a key's hash part the order into 4,096 ranges, so no task numbers all rows."""
    h = hashed(seed, key)
    return placed(rows, F.substring(h, 1, 3), [h, key])


def laps(pool: DataFrame, name: str, count: int, seed: int) -> DataFrame:
    """``count`` names: the whole pool in a seeded order, then in another, and so on. A pool is a bounded library."""
    n = Window.partitionBy()
    each = pool.select(name).distinct().withColumn("_n", F.count("*").over(n)).withColumn("lap", F.explode(F.sequence(F.lit(0), F.ceil(F.lit(count) / F.col("_n")).cast("int") - 1)))
    order = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("lap").cast("string"), F.col(name).cast("string")))
    within = F.row_number().over(Window.partitionBy("lap").orderBy(order, name))
    return each.withColumn("place", (F.col("lap") * F.col("_n") + within).cast("int")).where(F.col("place") <= count).select("place", "lap", name)


def holdout(rows: DataFrame, place: str, pinned: DataFrame, share: float, seed: int) -> DataFrame:
    """``rows`` with ``side``: whole places are held out, pinned ones first, then others in seeded order up to the share."""
    places = rows.select(place).distinct().join(pinned.select(place, F.lit(True).alias("_pin")).distinct(), place, "left").withColumn("_pin", F.coalesce("_pin", F.lit(False)))
    total = places.agg(F.greatest(F.lit(1), F.bround(F.count("*") * share).cast("int")).alias("_want"), F.count_if("_pin").alias("_held"))
    order = shuffled(places.where("not _pin").select(place), place, seed).crossJoin(F.broadcast(total)).where("place <= greatest(0, _want - _held)")  # one row
    held = order.select(place).unionByName(places.where("_pin").select(place)).withColumn("_h", F.lit(True))
    return rows.join(held, place, "left").withColumn("side", F.when(F.col("_h"), "holdout").otherwise("train")).drop("_h")


def training_side(rows: DataFrame, group: str, share: float, seed: int) -> DataFrame:
    """Whole groups, in seeded order, as a selection slice until it has ``share`` of the rows."""
    g = rows.groupBy(group).agg(F.count("*").alias("n"))
    total = rows.agg((F.count("*") * share).alias("_want"))
    order = Window.partitionBy().orderBy(hashed(seed, group), group).rowsBetween(Window.unboundedPreceding, -1)
    took = g.withColumn("_before", F.coalesce(F.sum("n").over(order), F.lit(0))).crossJoin(F.broadcast(total))  # one row
    return took.select(group, "n", (F.col("_before") < F.col("_want")).alias("selected"))


def corpus_plan(supply: DataFrame, part: str, key: str, quota: DataFrame, seed: int, hard: float = 0.7) -> DataFrame:
    """The seeded first ``quota`` places of each partition in one seeded order; the first share of it is hard."""
    own = Window.partitionBy(part).orderBy(hashed(seed, key), key)
    chosen = supply.select(part, key).withColumn("_i", F.row_number().over(own)).join(F.broadcast(quota.select(part, "quota")), part).where("_i <= quota").drop("_i", "quota")  # a row per partition
    plan = shuffled(chosen, key, seed + 1)
    total = chosen.agg(F.bround(F.count("*") * hard).cast("int").alias("_hard"))
    return plan.crossJoin(F.broadcast(total)).select("place", part, key, F.when(F.col("place") <= F.col("_hard"), "hard").otherwise("uniform").alias("kind"))  # one row


def finished_weights(rows: DataFrame, cls: str, biased: Column, beta: float) -> DataFrame:
    """One over the root of the class's size, and ``beta`` for biased rows."""
    sizes = rows.groupBy(cls).agg(F.count("*").alias("_c"))
    return rows.join(F.broadcast(sizes), cls).withColumn("weight", 1 / F.sqrt("_c") * F.when(biased, beta).otherwise(1.0)).drop("_c")  # a row per class


def group_summary(groups: DataFrame, rows: DataFrame, key: str, group: str) -> DataFrame:
    """Of ``(key, group)``: groups, the largest, those of one, and rows without one."""
    sizes = groups.groupBy(group).agg(F.count("*").alias("n"))
    got = sizes.agg(F.count("*").alias("groups"), F.coalesce(F.max("n"), F.lit(0)).alias("largest"), F.count_if(F.col("n") == 1).alias("singletons"))
    without = rows.join(groups.select(key), key, "left_anti").agg(F.count("*").alias("unplaced"))
    return got.crossJoin(F.broadcast(without))  # one row


def pruned(frontier: DataFrame, priority: str, key: str, cap: int) -> DataFrame:
    """The ``cap`` nodes of greatest priority, ties by key."""
    return frontier.orderBy(F.desc(priority), key).limit(cap)


def grown(pins: DataFrame, more: DataFrame, key: str) -> DataFrame:
    """Pins and what is added, once each; nothing ever leaves. ``state`` tells what is new."""
    old = pins.select(key, F.lit("kept").alias("state")).dropDuplicates([key])
    new = more.select(key).distinct().join(old, key, "left_anti").withColumn("state", F.lit("added"))
    return old.unionByName(new)


def bound(paths: DataFrame, position: str, resolved: str) -> DataFrame:
    """Each resolved path once, at its first position."""
    whole = F.struct(*paths.columns)
    return paths.groupBy(resolved).agg(F.min_by(whole, F.col(position)).alias("_r")).select("_r.*")


def merged_counts(one: DataFrame, two: DataFrame, name: str, count: str) -> DataFrame:
    return one.select(name, count).unionByName(two.select(name, count)).groupBy(name).agg(F.sum(count).alias(count))


def canonical_slot(tiles: DataFrame, key: str, slot: str, tile: str) -> DataFrame:
    """The tile of slot 0 of each place; a place without one is an error."""
    zero = tiles.groupBy(key).agg(F.min(F.when(F.col(slot) == 0, F.col(tile))).alias("_t"))
    kind = tiles.schema[tile].dataType.simpleString()
    return zero.select(key, F.when(F.col("_t").isNotNull(), F.col("_t")).otherwise(F.raise_error(F.concat(F.lit("no slot 0: "), F.col(key).cast("string"))).cast(kind)).alias(tile))


#: Cells across a tile, and the rows that are compared with what a tile has kept at once.
TILE, CHUNK = 32, 4096


def _decided(batch: pa.RecordBatch, tile: dict, radius: float, strict: bool, shift: int) -> np.ndarray:
    """Rows of one tile, in order, that are not lost to a kept one: 1 kept, 2 open. Rows of other tiles are 0, as are
    those lost and those that came as kept."""
    column = lambda n: batch.column(n).to_numpy(zero_copy_only=False)
    x, y, was = column("x"), column("y"), column("state")
    cx, cy = column("cx"), column("cy")
    left, top = int(column("tx")[0]) * TILE - shift % 2 * (TILE // 2), int(column("ty")[0]) * TILE - shift // 2 * (TILE // 2)
    # Cells of the tile and two around it; two more that hold nothing, so that each has all its neighbours.
    i, j = (cx - left).astype(np.int64) + 4, (cy - top).astype(np.int64) + 4
    inner = (i >= 4) & (i < TILE + 4) & (j >= 4) & (j < TILE + 4)
    if not tile:
        tile |= {"x": np.full((TILE + 8, TILE + 8), np.nan), "y": np.full((TILE + 8, TILE + 8), np.nan), "open": np.zeros((TILE + 8, TILE + 8), bool)}
    kx, ky, waits = tile["x"], tile["y"], tile["open"]
    most = radius * radius
    lost = np.zeros(len(x), bool)
    for u in range(-2, 3):
        for v in range(-2, 3):
            gap = (x - kx[i + u, j + v]) ** 2 + (y - ky[i + u, j + v]) ** 2
            lost |= gap <= most if strict else gap < most
    out = np.zeros(len(x), np.int32)
    for n in np.flatnonzero(~lost | (was == 1)).tolist():
        here, p, q = (slice(i[n] - 2, i[n] + 3), slice(j[n] - 2, j[n] + 3)), i[n], j[n]
        if was[n] != 1:
            gap = (x[n] - kx[here]) ** 2 + (y[n] - ky[here]) ** 2
            if (gap <= most if strict else gap < most).any():
                continue
            # What lies before it in reach, or in cells in reach, isn't decided; nor is what another tile decides.
            if not inner[n] or waits[here].any():
                waits[p, q] = True
                out[n] = 2 * inner[n]
                continue
            out[n] = 1
        kx[p, q], ky[p, q] = x[n], y[n]
    return out


#: The first points in order, as a share of all and at least so many, are decided by themselves. With at most so many kept
#: of them, these go to all tasks.
FIRST, LEAST, SENT = 1 / 64, 50_000, 50_000


def kept_apart(points: DataFrame, part: str, order: str, radius: float, scratch: Scratch, strict: bool = False) -> DataFrame:
    """In order, each point ``(id, part, x, y)`` that has at least ``radius`` (more, if ``strict``) to all kept before it.
    Points with a null or a number that isn't finite in ``part``, ``x`` or ``y`` are near nothing.

    A cell narrower than the radius on its diagonal holds one kept point at most, so what is kept is bounded by the plane
    and not by the points. What a share of the points keeps, the first in order, thus rules out most others where they are
    read, and only what is left of those moves. Where the order isn't a number, or more is kept than can be sent to all
    tasks, all points move.
    """
    fine = lambda c: F.coalesce(F.abs(F.col(c).cast("double")) < float("inf"), F.lit(False))
    usable = fine("x") & fine("y") & F.col(part).isNotNull()
    side = radius * 0.7071
    cell = lambda c: F.floor(F.col(c) / side)
    row = F.struct(*points.columns).alias("row")
    left = points.where(usable).select(F.col(part).alias("part"), F.col(order).alias("o"), "id", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"), row).withColumn("cx", cell("x")).withColumn("cy", cell("y"))
    left = left.withColumn("state", F.lit(2))
    kept = points.where(~usable)
    if isinstance(left.schema["o"].dataType, T.NumericType) and (n := left.count()) > LEAST:
        cut = left.agg(F.percentile_approx("o", max(FIRST, LEAST / n))).first()[0]
        # Nulls are first in order.
        early = F.coalesce(F.col("o") <= F.lit(cut), F.lit(True))
        done = scratch.keep(_all_decided(left.where(early), radius, scratch, strict))
        if done.count() <= SENT:
            kept = kept.unionByName(done.select("row.*"))
            left = done.withColumn("state", F.lit(1)).unionByName(_not_lost(left.where(~early), done, radius, strict))
    return kept.unionByName(_all_decided(left, radius, scratch, strict).select("row.*"))


def _not_lost(left: DataFrame, kept: DataFrame, radius: float, strict: bool) -> DataFrame:
    """Points that no kept one is near to, but for what rounding of cells lets by; ``kept`` goes to all tasks."""
    around = lambda c: F.explode(F.sequence(F.col(c) - 1, F.col(c) + 1))
    cell = lambda c: F.floor(F.col(c) / (radius * 1.001))
    # A part that isn't a number equals no other.
    odd = F.isnan("part") if isinstance(kept.schema["part"].dataType, T.FractionalType) and not isinstance(kept.schema["part"].dataType, T.DecimalType) else F.lit(False)
    near = kept.where(~odd).select(F.col("part").alias("k_part"), F.col("x").alias("k_x"), F.col("y").alias("k_y"), cell("x").alias("i"), cell("y").alias("j"))
    near = near.withColumn("i", around("i")).withColumn("j", around("j"))
    x, y = F.col("x") - F.col("k_x"), F.col("y") - F.col("k_y")
    gap, most = x * x + y * y, F.lit(radius * radius)
    lost = (F.col("part") == F.col("k_part")) & (cell("x") == F.col("i")) & (cell("y") == F.col("j")) & (gap <= most if strict else gap < most)
    return left.join(F.broadcast(near), lost, "left_anti")  # SENT points at most, nine times


def _all_decided(left: DataFrame, radius: float, scratch: Scratch, strict: bool) -> DataFrame:
    """The open points (``state`` 2) that stay, those of state 1 being kept already and before them in order.

    Tiles of cells are passed in order, each by itself, as a stream: a point near a kept one goes, one with only decided
    cells around it stays, and one that hangs on another tile stays open, as do those after it near by. Tiles then move by
    half their side, until no point is open; the first open point of all is decided in each round. A round reads what is
    open and what the last one kept.
    """
    columns = left.columns
    kept, turn = left.where("false"), 0
    while True:
        shift = (0, 3, 1, 2)[turn % 4]
        tiles = lambda c, s: F.explode(F.sequence(F.floor((F.col(c) + (s * (TILE // 2) - 2)) / TILE), F.floor((F.col(c) + (s * (TILE // 2) + 2)) / TILE)))  # noqa: E731, B023
        dealt = left.withColumn("tx", tiles("cx", shift % 2)).withColumn("ty", tiles("cy", shift // 2))
        dealt = dealt.repartition("part", "tx", "ty").sortWithinPartitions("part", "tx", "ty", "o", "id")

        def run(batches, shift=shift):
            last, tile = None, {}
            for batch in batches:
                if not batch.num_rows:
                    continue
                keys = [batch.column(n) for n in ("part", "tx", "ty")]
                fresh = np.zeros(batch.num_rows, bool)
                fresh[0] = True
                for k in keys:
                    fresh[1:] |= pc.not_equal(k[1:], k[:-1]).to_numpy(zero_copy_only=False)
                starts = np.flatnonzero(fresh).tolist()
                state = np.zeros(batch.num_rows, np.int32)
                for a, b in zip(starts, [*starts[1:], batch.num_rows], strict=True):
                    own = tuple(k[a].as_py() for k in keys)
                    if own != last:
                        last, tile = own, {}
                    # Short chunks while a tile has kept little, since most of what follows is lost to it.
                    size = 64
                    while a < b:
                        part_of = batch.slice(a, min(size, b - a))
                        state[a : a + part_of.num_rows] = _decided(part_of, tile, radius, strict, shift)
                        a, size = a + part_of.num_rows, min(CHUNK, 2 * size)
                some = np.flatnonzero(state)
                if len(some):
                    out = batch.select(columns[:-1]).take(pa.array(some))
                    yield pa.RecordBatch.from_arrays([*out.columns, pa.array(state[some], pa.int32())], names=columns)

        found = scratch.keep(dealt.mapInArrow(run, left.schema))
        if turn:
            scratch.drop(left)
        done = scratch.keep(found.where("state = 1"))
        kept = kept.unionByName(done)
        if not found.where("state = 2").limit(1).count():
            return kept
        left, turn = found, turn + 1


def roulette(rows: DataFrame, part: str, key: str, score: str, seed: int) -> DataFrame:
    """One row per partition, drawn in proportion to its score: the greatest of log(score) plus a keyed Gumbel draw."""
    u = (F.pmod(F.xxhash64(F.col(part).cast("string"), F.col(key).cast("string"), F.lit(seed)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    good = rows.where(F.col(score) > 0).withColumn("_g", F.ln(score) - F.ln(-F.ln(u)))
    whole = F.struct(*rows.columns)
    return good.groupBy(part).agg(F.max_by(whole, F.struct("_g", key)).alias("_r")).select("_r.*")


def density_point(tiles: DataFrame, frame: str, across: int, down: int, floor: float) -> DataFrame:
    """Where a frame's edge energy lies, as shares of its sides: the centroid of its tiles ``(frame, tx, ty, energy)``, or
    the middle of its busiest tile where the centroid falls on an empty one."""
    e = F.col("energy")
    got = tiles.groupBy(frame).agg(F.sum(e).alias("s"), F.sum(e * (F.col("tx") + 0.5) / across).alias("wx"), F.sum(e * (F.col("ty") + 0.5) / down).alias("wy"), F.max_by(F.struct("tx", "ty"), F.struct(e, -F.col("ty"), -F.col("tx"))).alias("peak"))
    got = got.withColumn("fx", F.when(F.col("s") > 0, F.col("wx") / F.col("s")).otherwise(0.5)).withColumn("fy", F.when(F.col("s") > 0, F.col("wy") / F.col("s")).otherwise(0.5))
    at = got.withColumn("tx", F.least(F.floor(F.col("fx") * across), F.lit(across - 1))).withColumn("ty", F.least(F.floor(F.col("fy") * down), F.lit(down - 1)))
    here = at.join(tiles.select(frame, "tx", "ty", e.alias("here")), [frame, "tx", "ty"], "left")
    empty = F.coalesce(F.col("here"), F.lit(0.0)) < floor
    return here.select(frame, F.when(empty, (F.col("peak.tx") + 0.5) / across).otherwise(F.col("fx")).alias("fx"), F.when(empty, (F.col("peak.ty") + 0.5) / down).otherwise(F.col("fy")).alias("fy"))


def nearest(points: DataFrame, accepted: DataFrame, part: str) -> DataFrame:
    """Distance of each point ``(id, part, x, y)`` to the nearest accepted one of its partition, and which: the first of
    the nearest; null where there is none.

    Cells whose side doubles from round to round would need a loop; here each point meets the accepted points of its own
    coarse cell and the eight around it, at four scales, each only where the scale before found nothing closer than its
    side; what is left, far from everything, meets all of its partition's.
    """
    span = points.select(part, "x", "y").unionByName(accepted.select(part, "x", "y")).groupBy(part).agg((F.greatest(F.max("x") - F.min("x"), F.max("y") - F.min("y")) + 1e-12).alias("_span"))
    n = accepted.groupBy(part).agg(F.count("*").alias("_n"))
    side = span.join(n, part).withColumn("_side", F.col("_span") / F.sqrt(F.col("_n")))
    left, found = points, None
    steps = F.array(*[F.lit(k) for k in (-1, 0, 1)])
    gap = F.sqrt(F.pow(F.col("x") - F.col("x2"), 2) + F.pow(F.col("y") - F.col("y2"), 2))
    best = F.min(F.struct(gap.alias("distance"), F.col("id2").alias("nearest"))).alias("_b")
    for k in range(4):
        s = side.select(part, (F.col("_side") * 3.0**k).alias("_s"))
        cell = lambda c: F.floor(F.col(c) / F.col("_s"))
        a = accepted.join(F.broadcast(s), part).withColumn("i", F.explode(steps)).withColumn("j", F.explode(steps))  # a row per partition
        a = a.select(part, F.col("id").alias("id2"), F.col("x").alias("x2"), F.col("y").alias("y2"), (cell("x") + F.col("i")).alias("cx"), (cell("y") + F.col("j")).alias("cy"))
        p = left.join(F.broadcast(s), part, "left").withColumn("cx", cell("x")).withColumn("cy", cell("y"))
        got = p.join(a, [part, "cx", "cy"]).groupBy("id", "_s").agg(best).where("_b.distance <= _s").select("id", "_b.*")
        found = got if found is None else found.unionByName(got)
        left = left.join(got.select("id"), "id", "left_anti")
    rest = left.join(accepted.select(part, F.col("id").alias("id2"), F.col("x").alias("x2"), F.col("y").alias("y2")), part, "left").groupBy("id").agg(best).select("id", "_b.*")
    return points.join(found.unionByName(rest), "id", "left").select("id", part, "distance", F.when(F.col("distance").isNotNull(), F.col("nearest")).alias("nearest"))
