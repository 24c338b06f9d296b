"""Identities of places against plain Python."""

import json
import random
from decimal import Decimal, InvalidOperation

import pytest
from pyspark.sql import functions as F

from tessera.functions import places as P


def plain(text):
    try:
        number = Decimal(text)
    except InvalidOperation:
        return text
    return "0" if number == 0 else format(number.normalize(), "f")


def test_canonical_decimal(spark):
    rng = random.Random(1)
    texts = ["0", "-0", "0.000", "1e-12", "1.50", "-1.50", "100", "1E+3", "abc", "", ".", ".5", "5.", "+7", "-.50e2", "0.1234567890123456789012345678901234567", "9" * 28, "9" * 29, "1" + "0" * 40, "12345678901234567890123456785" + "0", "1234567890123456789012345675", "12345678901234567890123456785", "12345678901234567890123456775", "1e30", "e5", "-"]
    for _ in range(600):
        d = "".join(rng.choice("0123456789") for _ in range(rng.randint(1, 40)))
        at = rng.randint(0, len(d))
        texts.append(rng.choice(["", "-", "+"]) + d[:at] + rng.choice(["", "."]) + d[at:] + rng.choice(["", "", f"e{rng.randint(-40, 40)}"]))
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", P.canonical_decimal(F.col("t")).alias("c")).collect()
    for r in got:
        assert r.c == plain(r.t), r.t
    assert spark.range(1).select(P.canonical_decimal(F.lit(None).cast("string"))).first()[0] is None


FAMILY = "struct<kind string, degree int, c array<string>, p array<string>, z_prev array<string>>"
VIEW = "struct<center_re string, center_im string, width string>"


def test_keys(spark):
    rows = [
        (("mandelbrot", None, None, None, None), ("0.50", "-0", "3.0"), "mandelbrot", ["mandelbrot", 2, [], "0.5", "0", "3"]),
        (("julia", 3, ["0.10", "2"], None, None), ("0", "0", "1e-3"), "julia:multibrot3", ["julia:multibrot3", 3, [["0.1", "2"]], "0", "0", "0.001"]),
        (("julia", 2, None, None, None), ("0", "0", "1"), "julia:mandelbrot", ["julia:mandelbrot", 2, [None], "0", "0", "1"]),
        (("phoenix", None, ["0.56670", "0"], None, ["0", "-0"]), ("0", "0", "1"), "phoenix:classic", ["phoenix:classic", 2, [["0.5667", "0"], None, ["0", "0"]], "0", "0", "1"]),
        (("phoenix", None, ["0.5", "0"], None, None), ("0", "0", "1"), "phoenix", ["phoenix", 2, [["0.5", "0"], None, None], "0", "0", "1"]),
        (("multibrot", 7, None, None, None), ("0", "0", "1"), None, None),
        (("other", None, None, None, None), ("0", "0", "1"), None, None),
        (None, ("0", "0", "1"), None, None),
        (("mandelbrot", None, None, None, None), ("0", None, "1"), "mandelbrot", None),
        (("mandelbrot", None, None, None, None), None, "mandelbrot", None),
    ]
    docs = spark.createDataFrame([(i, r[0], r[1]) for i, r in enumerate(rows)], f"id int, family {FAMILY}, viewport {VIEW}")
    got = docs.select("id", P.partition_of(F.col("family")).alias("p"), P.location_key(F.col("family"), F.col("viewport")).alias("k")).orderBy("id").collect()
    for r, (_, _, part, key) in zip(got, rows, strict=True):
        assert r.p == part
        assert r.k == (None if key is None else json.dumps(key)), r
    with pytest.raises(Exception, match="no registered partition"):
        docs.select(P.required(P.partition_of(F.col("family")), F.col("family.kind"))).collect()


def test_predicates(spark):
    rows = [("survived", 0.4, 0.2), ("survived", 0.4, None), ("expandable", 0.2, 0.9), ("interior", 0.9, 0.9), ("not_admitted", None, None), (None, 0.9, 0.9)]
    f, s, g = F.col("f"), F.col("s"), F.col("g")
    got = spark.createDataFrame(rows, "f string, s double, g double").select(P.passes_gates(f), P.is_admitted(f, s), P.good_class(s, g), P.clears(s, 0.385), P.score_band(s)).collect()
    assert [tuple(r) for r in got] == [(True, True, 4, True, 2), (True, True, 3, True, 2), (True, False, None, False, 2), (False, False, 4, True, 4), (True, False, None, None, None), (False, False, 4, True, 4)]
