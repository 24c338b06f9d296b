"""Scalar functions as column expressions."""

from __future__ import annotations

import hashlib
import json

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def sigmoid(x: Column) -> Column:
    """Logistic function that never overflows."""
    e = F.exp(-F.abs(x))
    return F.when(x >= 0, 1 / (1 + e)).otherwise(e / (1 + e))


def running_product(values: Column) -> Column:
    """Products of the array's prefixes: conditional probabilities to cumulative ones."""
    state = F.struct(F.array().cast("array<double>").alias("out"), F.lit(1.0).alias("p"))
    step = lambda s, v: F.struct(F.concat(s["out"], F.array(s["p"] * v)).alias("out"), (s["p"] * v).alias("p"))
    return F.aggregate(values, state, step, lambda s: s["out"])


def rank_score(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, v: a + v)


def decoded_tier(values: Column, edge: float = 0.5) -> Column:
    return F.size(F.filter(values, lambda p: p >= edge)) + 1


def saturation_discount(density: Column, strength: float) -> Column:
    return F.when(density <= 0, 1.0).otherwise(1 / (1 + strength * density))


def keyed_uniform(seed: int, *key: str) -> Column:
    """A number in (0, 1) that depends on the seed and the key alone."""
    return (F.pmod(F.xxhash64(*[F.col(k) for k in key], F.lit(seed)), F.lit(1 << 52)) + 0.5) / float(1 << 52)


def gumbel_priority(score: Column, depth: Column, uniform: Column) -> Column:
    return F.coalesce(score, F.lit(0.0)) - F.ln(-F.ln(uniform)) + 0.02 * depth


def log_uniform(low: float, high: float, uniform: Column) -> Column:
    return F.exp(F.ln(F.lit(low)) + uniform * (F.ln(F.lit(high)) - F.ln(F.lit(low))))


def iteration_cap(width: Column) -> Column:
    """4000 (1 + 0.3 log2(3 / width)), between 200 and 67000, truncated; 4000 where the width is no positive number."""
    usable = F.coalesce(~F.isnan(width) & (width > 0), F.lit(False))
    return F.when(~usable, F.lit(4000)).otherwise(F.least(F.greatest(4000 * (1 + 0.3 * F.log2(3 / width)), F.lit(200.0)), F.lit(67000.0)).cast("long")).cast("long")


def transfer(kind: Column, x: Column) -> Column:
    """A curve of what lies from 0 to 1; beyond, its ends."""
    x = F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0))
    return F.when(kind == "sqrt", F.sqrt(x)).when(kind == "log", F.log1p(x) / F.ln(F.lit(2.0))).when(kind == "smoothstep", x * x * (3 - 2 * x)).otherwise(x)


def rolloff(kind: Column, x: Column, knee: float = 0.8) -> Column:
    """Highlights pulled below 1: a soft knee, Reinhard's curve, or the filmic curve (fixed values)."""
    soft = F.when(x <= knee, x).otherwise(knee + (1 - knee) * F.tanh((x - knee) / (1 - knee)))
    film = x * (2.51 * x + 0.03) / (x * (2.43 * x + 0.59) + 0.14)
    return F.when(kind == "soft", soft).when(kind == "reinhard", x / (1 + x)).when(kind == "aces", F.least(F.greatest(film, F.lit(0.0)), F.lit(1.0))).otherwise(x)


def blend(kind: Column, a: Column, b: Column) -> Column:
    over = F.when(a < 0.5, 2 * a * b).otherwise(1 - 2 * (1 - a) * (1 - b))
    return (
        F.when(kind == "multiply", a * b)
        .when(kind == "screen", 1 - (1 - a) * (1 - b))
        .when(kind == "overlay", over)
        .when(kind == "min", F.least(a, b))
        .when(kind == "add", F.least(a + b, F.lit(1.0)))
        .otherwise(b)
    )


def linear(c: Column) -> Column:
    """sRGB to linear light (fixed values)."""
    return F.when(c <= 0.04045, c / 12.92).otherwise(F.pow((c + 0.055) / 1.055, F.lit(2.4)))


def encoded(c: Column) -> Column:
    return F.when(c <= 0.0031308, 12.92 * c).otherwise(1.055 * F.pow(c, F.lit(1 / 2.4)) - 0.055)


#: The Oklab transform's two matrices, fixed values.
TO_LMS = ((0.4122214708, 0.5363325363, 0.0514459929), (0.2119034982, 0.6806995451, 0.1073969566), (0.0883024619, 0.2817188376, 0.6299787005))
TO_LAB = ((0.2104542553, 0.7936177850, -0.0040720468), (1.9779984951, -2.4285922050, 0.4505937099), (0.0259040371, 0.7827717662, -0.8086757660))


def oklab(r: Column, g: Column, b: Column) -> Column:
    """``struct<l, a, b>`` of linear red, green and blue."""
    roots = [F.cbrt(m[0] * r + m[1] * g + m[2] * b) for m in TO_LMS]
    return F.struct(*[(m[0] * roots[0] + m[1] * roots[1] + m[2] * roots[2]).alias(n) for m, n in zip(TO_LAB, "lab", strict=True)])


def turn(y: Column, x: Column) -> Column:
    return F.pmod(F.atan2(y, x) / (2 * np.pi), F.lit(1.0))


def content_digest(*cols: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws("|", *cols), 256), 1, 16)


@F.pandas_udf(T.LongType())
def stable_id(keys):
    """52 bits of the BLAKE2b digest of a key's JSON text."""
    return keys.map(lambda k: None if k is None else int.from_bytes(hashlib.blake2b(json.dumps(k).encode(), digest_size=8).digest(), "big") & ((1 << 52) - 1))


@F.pandas_udf(T.LongType())
def split_mix(values):
    """The 64-bit mixer, as a signed number (fixed values)."""
    import pandas as pd

    z = values.to_numpy("int64").view("uint64") + np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return pd.Series((z ^ (z >> np.uint64(31))).view("int64"))


@F.pandas_udf(T.LongType())
def sub_seed(seeds, ids):
    """A node's stream: the mixer of the seed and the node's number times the golden ratio (fixed value)."""
    import pandas as pd

    z = seeds.to_numpy("int64").view("uint64") ^ (ids.to_numpy("int64").view("uint64") * np.uint64(0x9E3779B97F4A7C15))
    return split_mix.func(pd.Series(z.view("int64")))


@F.pandas_udf(T.StringType())
def long_digest(keys):
    """128 bits of the BLAKE2b digest of a key's JSON text, as hexadecimal digits; the first 12 name a seed."""
    return keys.map(lambda k: None if k is None else hashlib.blake2b(json.dumps(k).encode(), digest_size=16).hexdigest())


def ulps(step: Column, magnitude: Column) -> Column:
    """How many representable numbers lie between two samples ``step`` apart at ``magnitude``."""
    return step / F.pow(F.lit(2.0), F.floor(F.log2(F.abs(magnitude))) - 52)


def clamp01(x: Column) -> Column:
    return F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0))


def light_kept(kind: Column, r: Column, g: Column, b: Column) -> Column:
    """``struct<r, g, b>`` of linear light, scaled so that its luminance follows the roll-off's curve (fixed weights),
    within 0 to 1; without a curve, or of black, as it is."""
    y = 0.2126 * r + 0.7152 * g + 0.0722 * b
    plain = ~kind.isin("soft", "reinhard", "aces") | (y <= 1e-9)
    scale = rolloff(kind, y) / y
    return F.struct(*[F.when(plain, c).otherwise(clamp01(c * scale)).alias(n) for n, c in (("r", r), ("g", g), ("b", b))])


def merged(kind: Column, under_first: Column, over: Column, under: Column) -> Column:
    """A blend whose arguments come in one order or the other."""
    return F.when(under_first, blend(kind, under, over)).otherwise(blend(kind, over, under))


#: The way back from Oklab, two matrices, fixed values.
FROM_LAB = ((1.0, 0.3963377774, 0.2158037573), (1.0, -0.1055613458, -0.0638541728), (1.0, -0.0894841775, -1.2914855480))
FROM_LMS = ((4.0767416621, -3.3077115913, 0.2309699292), (-1.2684380046, 2.6097574011, -0.3413193965), (-0.0041960863, -0.7034186147, 1.7076147010))
#: Those are rounded on their own, so a colour comes back changed by some 1e-6; the inverses of TO_LAB and TO_LMS undo
#: them to the last places.
UNDO_LAB, UNDO_LMS = (tuple(tuple(float(x) for x in row) for row in np.linalg.inv(np.array(m))) for m in (TO_LAB, TO_LMS))


def from_oklab(l: Column, a: Column, b: Column) -> Column:
    """``struct<r, g, b>`` of linear light: what ``oklab`` was given."""
    cubes = [F.pow(m[0] * l + m[1] * a + m[2] * b, F.lit(3.0)) for m in UNDO_LAB]
    return F.struct(*[(m[0] * cubes[0] + m[1] * cubes[1] + m[2] * cubes[2]).alias(n) for m, n in zip(UNDO_LMS, "rgb", strict=True)])


def sector_address(symbols: Column, base: int) -> Column:
    """Symbols of successive steps as the digits of a number from 0 to 1."""
    return F.aggregate(symbols, F.struct(F.lit(0.0).alias("v"), F.lit(1.0 / base).alias("w")), lambda s, d: F.struct((s["v"] + d * s["w"]).alias("v"), (s["w"] / base).alias("w")), lambda s: s["v"])


def tone_projection(x: Column, low: Column, high: Column) -> Column:
    """``struct<value, side>``: what a band leaves of ``x``, and on which side it was cut (-1, 0, 1)."""
    return F.struct(F.least(F.greatest(x, low), high).alias("value"), F.when(x < low, -1).when(x > high, 1).otherwise(0).alias("side"))
