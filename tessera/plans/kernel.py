"""Queries that render frames and measure them."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import kernel as K
from tessera.operators.measure import mid_rank
from tessera.sources.tables import table

QUERIES, ORACLES = {}, {}
STATS = "id long, interior double, escaped long, median double, p5 double, p95 double, spread double, low double, high double, occupancy double, fate string"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def family_of(r) -> K.Family:
    return K.Family(r.kind, r.degree, complex(r.c_re, r.c_im), complex(r.p_re, r.p_im))


def measured(frames: DataFrame, columns: int = 96, rows: int = 54, limit: int = 200) -> DataFrame:
    """Statistics of each frame; a frame is a unit of work, so tasks scale with frames."""

    def run(batches):
        for pdf in batches:
            out = [{"id": r.id} | K.frame(complex(r.re, r.im), r.width, family_of(r), columns, rows, limit) for r in pdf.itertuples()]
            yield pd.DataFrame(out, columns=[c.split()[0] for c in STATS.split(", ")]).astype({"escaped": "Int64"})

    return frames.mapInPandas(run, STATS)


def gathered(frames: DataFrame, fields: tuple[str, ...], reductions: tuple[str, ...], columns: int = 48, rows: int = 27, limit: int = 100) -> DataFrame:
    """Mean and number of values of each field of each frame."""
    schema = "id long, field string, n long, mean double, low double, high double"

    def run(batches):
        for pdf in batches:
            out = []
            for r in pdf.itertuples():
                got = K.gather(K.grid(complex(r.re, r.im), r.width, columns, rows), family_of(r), limit, fields, reductions)
                for name, v in got.items():
                    if name != "interior":
                        good = v[np.isfinite(v)]
                        low, span = K.colour.stretch(v)
                        out.append((r.id, name, good.size, float(good.mean()) if good.size else None, low, low + span))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in schema.split(", ")])

    return frames.mapInPandas(run, schema)


def pictured(frames: DataFrame, modes: dict[str, dict], columns: int = 64, rows: int = 36, limit: int = 100) -> DataFrame:
    """Each frame in each mode, resampled from twice its size: its occupancy and mean colour."""
    schema = "id long, mode string, occupancy double, red double, green double, blue double"

    def run(batches):
        for pdf in batches:
            out = []
            for r in pdf.itertuples():
                points = K.grid(complex(r.re, r.im), r.width, 2 * columns, 2 * rows)
                for name, linear in K.all_drawn(points, family_of(r), limit, modes):
                    picture = K.colour.resampled(linear, columns, rows)
                    out.append((r.id, name, K.occupancy(picture), *picture.reshape(-1, 3).mean(0).tolist()))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in schema.split(", ")])

    return frames.mapInPandas(run, schema)


def frames(spark, d) -> DataFrame:
    """One frame per supplier, on the boundary of a family's main body."""
    k = F.col("s_suppkey")
    t = k * 0.6180339887498949 * 2 * np.pi
    kind = F.when(k % 3 == 0, "multibrot").when(k % 3 == 1, "julia").otherwise("phoenix")
    degree = F.when(k % 3 == 2, 2).otherwise(2 + (k % 2)).cast("int")
    return table(spark, d, "supplier").select(k.alias("id"), kind.alias("kind"), degree.alias("degree"), (F.cos(t) / 2 - F.cos(2 * t) / 4).alias("re"), (F.sin(t) / 2 - F.sin(2 * t) / 4).alias("im"),
                                              F.pow(F.lit(10.0), -(k % 4)).alias("width"), F.when(k % 3 == 2, 0.5667).otherwise(-0.4).alias("c_re"), F.when(k % 3 == 2, 0.0).otherwise(0.6).alias("c_im"),
                                              F.lit(-0.5).alias("p_re"), F.lit(0.0).alias("p_im"))


def dealt(spark, d) -> DataFrame:
    # Four tasks a core, since frames differ in cost and hashes deal few of them unevenly.
    return frames(spark, d).repartition(4 * spark.sparkContext.defaultParallelism, "id")


@query()
def field_gather(spark, d):
    return gathered(dealt(spark, d), K.FIELDS, K.LATTICE)


@query()
def mode_pictures(spark, d):
    return pictured(dealt(spark, d), K.MODES)


@query("select * from (values " + ", ".join(f"('{n}', '{m['kind']}')" for n, m in K.MODES.items()) + ") v(mode, kind)")
def mode_catalogue(spark, d):
    return spark.createDataFrame([(n, m["kind"]) for n, m in K.MODES.items()], "mode string, kind string")


@query()
def tone_statistics(spark, d):
    """Tones of each frame's smooth picture, the curve into some bands, and the middle that it gives."""
    schema = "id long, black double, black_all double, white double, middle double, neutral double, exponent double, new_middle double"
    bands = {"black": (0.05, 0.2), "white": (0.85, 0.97), "middle": (0.45, 0.6)}

    def run(batches):
        for pdf in batches:
            out = []
            for r in pdf.itertuples():
                linear = K.drawn(K.grid(complex(r.re, r.im), r.width, 64, 36), family_of(r), 100, K.MODES["smooth"])
                t = K.colour.tones(K.colour.to_bytes(linear))
                curve = K.colour.tone_curve(t, bands)
                out.append((r.id, t["black"], t["black_all"], t["white"], t["middle"], t["neutral"], curve and curve["exponent"], float(K.colour.toned(np.array([t["middle"]]), curve)[0])))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in schema.split(", ")])

    return dealt(spark, d).mapInPandas(run, schema)


@query()
def period_candidates(spark, d):
    def run(batches):
        for pdf in batches:
            yield pd.DataFrame([(r.id, K.period_candidates(complex(r.re, r.im), r.degree)) for r in pdf.itertuples()], columns=["id", "periods"])

    return dealt(spark, d).mapInPandas(run, "id long, periods array<int>")


@query()
def gradient_tables(spark, d):
    """A gradient per nation: baked, folded and reversed, at five places."""

    def run(batches):
        for pdf in batches:
            out = []
            for k in pdf["k"]:
                stops = [(0.0, (k * 9 % 256, 20, 60)), (0.4, (250, k * 31 % 256, 10)), (1.0, (30, 200, k * 5 % 256))]
                for name, made in (("plain", {}), ("folded", {"mirror": True}), ("reversed", {"reverse": True})):
                    colours = K.colour.to_bytes(K.colour.lookup(K.colour.bake(stops, **made), np.array([0.0, 0.25, 0.5, 0.75, 1.0])))
                    out += [(k, name, i, *map(int, c)) for i, c in enumerate(colours)]
            yield pd.DataFrame(out, columns=["nation", "bake", "place", "red", "green", "blue"])

    return table(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("k")).mapInPandas(run, "nation long, bake string, place int, red int, green int, blue int")


@query()
def screen_gates(spark, d):
    return measured(dealt(spark, d))


@query()
def gate_census(spark, d):
    return screen_gates(spark, d).groupBy("fate").agg(F.count("*").alias("n"), F.round(F.avg("interior"), 6).alias("interior"))


@query("select (r * 64 + c)::bigint as id, round(-0.5 + (c - 31.5) * 3.0 / 64, 10) as re, round((17.5 - r) * 3.0 / 64, 10) as im from range(36) a(r), range(64) b(c)")
def sample_grid(spark, d):
    g = spark.range(64 * 36).select("id", F.floor(F.col("id") / 64).alias("r"), (F.col("id") % 64).alias("c"))
    return g.select("id", F.round(-0.5 + (F.col("c") - 31.5) * 3.0 / 64, 10).alias("re"), F.round((17.5 - F.col("r")) * 3.0 / 64, 10).alias("im"))


@query("""with r as (select l_returnflag as part, l_extendedprice as v, row_number() over (partition by l_returnflag order by l_extendedprice) - 1 as i, count(*) over (partition by l_returnflag) as n from lineitem)
select part, max(v) filter (i = floor(0.005 * (n - 1) + 0.5)) as low, max(v) filter (i = floor(0.5 * (n - 1) + 0.5)) as median, max(v) filter (i = floor(0.995 * (n - 1) + 0.5)) as high from r group by part""")
def frame_stretch(spark, d):
    w = Window.partitionBy("part")
    # Nearest ranks from counts of distinct values: what a window sorts is combined before the shuffle.
    v = table(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("part"), F.col("l_extendedprice").alias("v")).agg(F.count("*").alias("k"))
    v = v.withColumn("past", F.sum("k").over(w.orderBy("v").rowsBetween(Window.unboundedPreceding, 0))).withColumn("n", F.sum("k").over(w))
    at = lambda p: F.floor(F.lit(p) * (F.col("n") - 1) + 0.5)
    pick = lambda p, name: F.max(F.when((F.col("past") > at(p)) & (F.col("past") - F.col("k") <= at(p)), F.col("v"))).alias(name)
    return v.groupBy("part").agg(pick(0.005, "low"), pick(0.5, "median"), pick(0.995, "high"))


@query("""select event_id, round((rank() over (partition by event_type order by value) - 1 + cume_dist() over (partition by event_type order by value) * count(*) over (partition by event_type)) / 2 / count(*) over (partition by event_type), 9) as rank_share from events""")
def rank_transfer(spark, d):
    # The share below and half of the equal: from mid-ranks of distinct values.
    rows = table(spark, d, "events").select("event_id", "event_type", "value")
    n = rows.groupBy("event_type").agg(F.count("*").alias("n"))
    ranks = mid_rank(rows, "value", ["event_type"], "r").join(F.broadcast(n), "event_type")  # a row per type
    share = ranks.select("event_type", "value", F.round((F.col("r") - 0.5) / F.col("n"), 9).alias("rank_share"))
    return rows.join(share, (rows["event_type"] == share["event_type"]) & rows["value"].eqNullSafe(share["value"])).select("event_id", "rank_share")
