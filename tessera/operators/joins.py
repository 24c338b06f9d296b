"""Joins of rows by the identity of their place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import places as P


def location_record(rows: DataFrame) -> DataFrame:
    """One shape for rows that keep their place in ``location`` or on the row, with defaults for what ``render`` lacks.

    ``maxiter`` stays null where nothing says one: that leaves the choice to the policy by depth.
    """
    pick = lambda c: F.coalesce(F.col(f"location.{c}"), F.col(c))
    return rows.select(
        "id", pick("family").alias("family"), pick("viewport").alias("viewport"), F.coalesce("render.across", F.lit(1920)).alias("across"),
        F.coalesce("render.supersample", F.lit(2)).alias("supersample"), F.coalesce("render.mode", F.lit("smooth")).alias("mode"), "maxiter",
    )


def scored_offer(rows: DataFrame, scores: DataFrame, key: str, fate: str, score: str) -> DataFrame:
    """Keyed rows that pass the gates with the sidecar's score; those it doesn't know keep a null one (and ``known``)."""
    side = scores.select(key, score, F.lit(True).alias("known"))
    return rows.where(F.col(key).isNotNull() & P.passes_gates(F.col(fate))).join(side, key, "left").withColumn("known", F.coalesce("known", F.lit(False)))


def funnel(offer: DataFrame, part: str, score: str) -> DataFrame:
    """How many rows each partition found, has scored, and has over both floors, the cap of a thin supply, and a line."""
    got = offer.groupBy(part).agg(F.count("*").alias("found"), F.count_if("known").alias("scored"), F.count_if(P.acts(F.col(score), P.JUNK_FLOOR)).alias("passing"), F.count_if(P.acts(F.col(score), P.GOOD_FLOOR)).alias("good"))
    line = F.concat(F.col(part), F.lit(": "), *[x for c in ("found", "scored", "passing", "good") for x in (F.col(c).cast("string"), F.lit(f" {c}"), F.lit(", "))][:-1])
    return got.select("*", F.floor(F.col("passing") / 4).alias("cap"), line.alias("line"))


def excluded(scores: DataFrame, labelled: DataFrame, key: str, foreign: Column) -> DataFrame:
    """``scores`` with their ``state``: labelled already, of another head, or eligible; in this order."""
    seen = labelled.select(key, F.lit(True).alias("_seen"))
    state = F.when(F.col("_seen"), "labelled").when(foreign, "other_head").otherwise("eligible")
    return scores.join(seen, key, "left").withColumn("state", state).drop("_seen")


def without_places(rows: DataFrame, reserved: list[DataFrame], key: str) -> DataFrame:
    every = reserved[0].select(key)
    for more in reserved[1:]:
        every = every.unionByName(more.select(key))
    return rows.join(every.distinct(), key, "left_anti")


def with_tiles(places: DataFrame, tiles: DataFrame, others: list[DataFrame], key: str, slot: str, tile: str) -> DataFrame:
    """``places`` with their ``tiles`` in slot order. A place without tiles, or one whose other regimes have another
    number of them, is an error."""

    def folded(frame: DataFrame, name: str) -> DataFrame:
        return frame.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(slot, tile))).alias(name))

    out = places.join(folded(tiles, "_t0"), key, "left")
    fault = F.when(F.col("_t0").isNull(), "no tiles")
    for k, other in enumerate(others, 1):
        out = out.join(folded(other, f"_t{k}"), key, "left")
        fault = F.coalesce(fault, F.when(F.coalesce(F.size(f"_t{k}"), F.lit(-1)) != F.size("_t0"), f"regime {k} has another number of tiles"))
    checked = F.when(fault.isNull(), F.transform("_t0", lambda t: t[tile])).otherwise(F.raise_error(F.concat(F.col(key).cast("string"), F.lit(": "), fault)).cast(f"array<{tiles.schema[tile].dataType.simpleString()}>"))
    return out.select(*places.columns, checked.alias("tiles"))


def pinned(rows: DataFrame, pins: DataFrame, key: str, side: str) -> DataFrame:
    """Pinned places go to the evaluation side; ``violation`` marks rows that stood on the other."""
    flag = pins.select(key, F.lit(True).alias("_pin"))
    out = rows.join(flag, key, "left").withColumn("violation", F.coalesce(F.col("_pin"), F.lit(False)) & (F.col(side) != "eval"))
    return out.withColumn(side, F.when(F.col("_pin"), "eval").otherwise(F.col(side))).drop("_pin")


def none_training(rows: DataFrame, pins: DataFrame, key: str, side: str) -> DataFrame:
    """``rows``; an error at the first training row of a pinned place."""
    bad = pinned(rows, pins, key, side)
    checked = F.when(~F.col("violation"), F.col(side)).otherwise(F.raise_error(F.concat(F.lit("pinned place trains: "), F.col(key))))
    return bad.select(*[checked.alias(c) if c == side else c for c in rows.columns])


def sheet_export(sheet: DataFrame, export: DataFrame, unit: str) -> DataFrame:
    """Each unit of a sheet or of what was exported, with how often it was: joined once, more, not, or not on the sheet."""
    got = export.groupBy(unit).agg(F.count("*").alias("units"))
    state = F.when(F.col("units").isNull(), "unanswered").when(F.col("_on").isNull(), "unknown").when(F.col("units") > 1, "repeated").otherwise("joined")
    return sheet.withColumn("_on", F.lit(True)).join(got, unit, "full").withColumn("state", state).drop("_on")


def closest_pair(points: DataFrame, part: str) -> DataFrame:
    """Smallest distance of two of a partition's points ``(id, part, x, y)``, of other ids and with no null; infinite where there are no two.

    Neighbours in order of x bound it from above. Within cells of that side every closer pair is in the same or a
    neighbouring cell, so the join is on equal cells, and no all-pairs product is made.
    """
    whole = points.where("id is not null and x is not null and y is not null")
    own = Window.partitionBy(part, "_c").orderBy("x", "id")
    gap = F.when(F.col("id") != F.lag("id").over(own), F.sqrt(F.pow(F.col("x") - F.lag("x").over(own), 2) + F.pow(F.col("y") - F.lag("y").over(own), 2)))
    # Strips bound what a window sorts; the bound holds for whatever neighbours it sees. There are fewer strips than
    # points, so one has two; if those are one id, the box around all points bounds it.
    span = whole.groupBy(part).agg(F.min("x").alias("_low"), F.max("x").alias("_high"), F.hypot(F.max("x") - F.min("x"), F.max("y") - F.min("y")).alias("_box"), F.ceil(F.count("*") / 4096).alias("_strips"))
    strip = F.when(F.col("_high") > F.col("_low"), F.least(F.floor((F.col("x") - F.col("_low")) / (F.col("_high") - F.col("_low")) * F.col("_strips")), F.col("_strips") - 1)).otherwise(0)
    near = whole.join(span, part).withColumn("_c", strip).withColumn("_g", gap).groupBy(part).agg(F.min("_g").alias("_bound"), F.coalesce(F.min("_g"), F.max("_box")).alias("_side"))
    some = whole.join(near, part).where("_side > 0")
    cell = lambda c: F.floor(F.col(c) / F.col("_side"))
    left = some.select(part, "id", "x", "y", cell("x").alias("cx"), cell("y").alias("cy"))
    steps = F.array(*[F.lit(k) for k in (-1, 0, 1)])
    right = some.withColumn("i", F.explode(steps)).withColumn("j", F.explode(steps))
    right = right.select(part, F.col("id").alias("id2"), F.col("x").alias("x2"), F.col("y").alias("y2"), (cell("x") + F.col("i")).alias("cx"), (cell("y") + F.col("j")).alias("cy"))
    pair = left.join(right, [part, "cx", "cy"]).where("id < id2")
    found = pair.groupBy(part).agg(F.min(F.sqrt(F.pow(F.col("x") - F.col("x2"), 2) + F.pow(F.col("y") - F.col("y2"), 2))).alias("_d"))
    parts = points.select(part).distinct().join(near, part, "left").join(found, part, "left")
    return parts.select(part, F.coalesce(F.least("_bound", "_d"), F.lit(float("inf"))).alias("distance"))


def below_bar(served: DataFrame, bars: DataFrame, judge: str, score: str) -> DataFrame:
    """Served rows that fail their judge's acting bar; a judge without a bar refuses none. One row per judge in ``bars``."""
    return served.join(F.broadcast(bars), judge).where(~F.coalesce(F.col(score) >= F.col("bar"), F.lit(False)))


def proven_roots(labels: DataFrame, key: str, part: str, tier: str, origin: str, least: int = 3) -> DataFrame:
    """Places that a person gave ``least`` or more, once each with their best tier."""
    good = labels.where(F.col(key).isNotNull() & (F.col(tier) >= least) & (F.col(origin) == "human"))
    return good.groupBy(key, part).agg(F.max(tier).alias(tier))


def visits(rows: DataFrame, ledger: str, own: str, part: Column) -> DataFrame:
    """Frames of all rows of all ledgers but one's own, refused ones too, as points and widths."""
    number = lambda c: F.col(f"viewport.{c}").cast("double")
    return rows.where(F.col(ledger) != own).select(part.alias("part"), number("center_re").alias("x"), number("center_im").alias("y"), number("width").alias("width"))


def machine_census(rows: DataFrame, labelled: DataFrame, part: str, key: str, order: list[str]) -> DataFrame:
    """Machine finds per partition: first of each place over all ledgers, those with a person's label suppressed."""
    first = rows.where(F.col(key).isNotNull() & P.passes_gates(F.col("fate"))).groupBy(key).agg(F.min_by(F.struct(part, "score", "great"), F.struct(*order)).alias("r"))
    seen = first.select(key, "r.*").join(labelled.select(key, F.lit(True).alias("_l")), key, "left").withColumn("_l", F.coalesce("_l", F.lit(False))).withColumn("_c", P.good_class(F.col("score"), F.col("great")))
    free = ~F.col("_l")
    return seen.groupBy(part).agg(F.count("*").alias("found"), F.count_if("_l").alias("suppressed"), F.count_if(free & F.col("_c").isNull()).alias("unclassed"), F.count_if(free & (F.col("_c") == 3)).alias("n3"), F.count_if(free & (F.col("_c") == 4)).alias("n4"))
