"""Identities and predicates of places: a family with its constants, and a viewport with decimal texts.

A family is ``struct<kind, degree, c, p, z_prev>`` (constants are arrays of two decimal texts, null where absent), a
viewport ``struct<center_re, center_im, width>`` of decimal texts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The registered partitions, the pinned point of the classic one, the constants that identify a family of
#: each kind, the fates that pass the gates, and the floors and cuts of scores.
PLANES = ("mandelbrot", "multibrot3", "multibrot4", "multibrot5")
PARTITIONS = (*PLANES, *(f"julia:{p}" for p in PLANES), "phoenix", "phoenix:classic")
CLASSIC = {"c": (0.5667, 0.0), "p": (-0.5, 0.0), "z_prev": (0.0, 0.0)}
CONSTANTS = {"julia": ("c",), "phoenix": ("c", "p", "z_prev")}
PASSING = ("survived", "expandable", "not_admitted")
GOOD_FLOOR, JUNK_FLOOR, GREAT_CUT, INTERIOR_RULE = 0.385, 0.100, 0.105, 0.12
RECIPE = ("gamma", "cycles", "phase", "reverse", "mirror", "transfer", "rolloff")

_NUMBER = r"^\s*([+-]?)(\d*)\.?(\d*)(?:[eE]([+-]?\d{1,4}))?\s*$"


def canonical_decimal(text: Column, digits: int = 28) -> Column:
    """Plain notation of a decimal text without zeros at its end, rounded half to even at ``digits``; any zero is 0.

    What is no number, or has an exponent of more than four digits, stays as it is; null stays null.
    """
    part = lambda k: F.regexp_extract(text, _NUMBER, k)
    is_number = text.rlike(_NUMBER) & text.rlike(r"^[^eE]*\d")
    start = F.struct(
        F.when(part(1) == "-", "-").otherwise("").alias("sign"),
        F.regexp_replace(F.concat(part(2), part(3)), "^0+", "").alias("d"),
        (F.coalesce(F.try_to_number(F.nullif(F.regexp_replace(part(4), r"^\+", ""), F.lit("")), F.lit("S9999")).cast("int"), F.lit(0)) - F.length(part(3))).alias("x"),
    )

    def rounded(z: Column) -> Column:
        head, rest = F.substr(z["d"], F.lit(1), F.lit(digits)), F.substr(z["d"], F.lit(digits + 1))
        half = F.concat(F.lit("5"), F.repeat(F.lit("0"), F.length(rest) - 1))
        odd = F.substr(head, F.lit(digits), F.lit(1)).isin("1", "3", "5", "7", "9")
        up = F.when((rest > half) | ((rest == half) & odd), 1).otherwise(0)
        more = F.length(z["d"]) > digits
        new = F.when(more, (head.cast("decimal(38,0)") + up).cast("string")).otherwise(z["d"])
        return F.struct(z["sign"].alias("sign"), new.alias("d"), F.when(more, z["x"] + F.length(rest)).otherwise(z["x"]).alias("x"))

    def stripped(z: Column) -> Column:
        d = F.regexp_replace(z["d"], "0+$", "")
        return F.struct(z["sign"].alias("sign"), d.alias("d"), (z["x"] + F.length(z["d"]) - F.length(d)).alias("x"))

    def shown(z: Column) -> Column:
        n = F.length(z["d"])
        whole = F.concat(z["d"], F.repeat(F.lit("0"), z["x"]))
        inside = F.concat(F.substr(z["d"], F.lit(1), n + z["x"]), F.lit("."), F.substr(z["d"], n + z["x"] + 1))
        small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -z["x"] - n), z["d"])
        return F.when(n == 0, "0").otherwise(F.concat(z["sign"], F.when(z["x"] >= 0, whole).when(n + z["x"] > 0, inside).otherwise(small)))

    # The arrays bind what is used many times: each step is computed once.
    done = reduce(lambda a, f: F.transform(a, f), (rounded, stripped, shown), F.array(start))
    return F.when(is_number, done[0]).otherwise(text)


def _pair(value: Column, default: tuple[float, float]) -> Column:
    return F.when(value.isNull(), F.lit(True)).otherwise((value[0].cast("double") == default[0]) & (value[1].cast("double") == default[1]))


def is_classic(family: Column) -> Column:
    """Whether all three constants are those of the classic point; an absent one is."""
    return F.coalesce(reduce(lambda a, b: a & b, [_pair(family[k], v) for k, v in CLASSIC.items()]), F.lit(False))


def registered(name: Column) -> Column:
    """``name`` if it is a registered partition; else null."""
    return F.when(name.isin(*PARTITIONS), name)


def partition_of(family: Column) -> Column:
    """The partition of a family, by kind, degree (2 where absent) and constants; null for one that has none."""
    degree = F.coalesce(family["degree"], F.lit(2))
    plane = F.when(degree == 2, "mandelbrot").otherwise(F.concat(F.lit("multibrot"), degree.cast("string")))
    kind = family["kind"]
    name = F.when(kind == "mandelbrot", "mandelbrot").when(kind == "phoenix", F.when(is_classic(family), "phoenix:classic").otherwise("phoenix")).when(kind == "multibrot", plane).when(kind == "julia", F.concat(F.lit("julia:"), plane))
    return registered(name)


def required(partition: Column, what: Column) -> Column:
    """``partition``; an error that names ``what`` where it is null."""
    return F.when(partition.isNotNull(), partition).otherwise(F.raise_error(F.concat(F.lit("no registered partition: "), F.coalesce(what.cast("string"), F.lit("null")))))


def partition_of_row(name: Column, family: Column) -> Column:
    """Of a row that names its family by a text or by a struct."""
    return F.coalesce(registered(name), partition_of(family))


def _text(value: Column) -> Column:
    """A JSON string."""
    return F.regexp_replace(F.to_json(F.array(value)), r"^\[|\]$", "")


def _constants(family: Column, names: dict[str, tuple[str, ...]]) -> Column:
    one = lambda c: F.when(c.isNull(), "null").otherwise(F.concat(F.lit("["), _text(canonical_decimal(c[0])), F.lit(", "), _text(canonical_decimal(c[1])), F.lit("]")))
    shown = F.lit("")
    for kind, fields in names.items():
        shown = F.when(family["kind"] == kind, F.concat_ws(", ", *[one(family[f]) for f in fields])).otherwise(shown)
    return F.concat(F.lit("["), shown, F.lit("]"))


def location_key(family: Column, viewport: Column) -> Column:
    """The identity of a place as JSON text: partition, degree, constants, centre and width, all canonical.

    Null where the family has no partition or the viewport lacks a part, so that such rows can be counted.
    """
    degree = F.coalesce(family["degree"], F.lit(2)).cast("string")
    frame = [_text(canonical_decimal(viewport[k])) for k in ("center_re", "center_im", "width")]
    whole = reduce(lambda a, b: a & b, [viewport[k].isNotNull() for k in ("center_re", "center_im", "width")])
    key = F.concat(F.lit("["), F.concat_ws(", ", _text(partition_of(family)), degree, _constants(family, CONSTANTS), *frame), F.lit("]"))
    return F.when(partition_of(family).isNotNull() & whole, key)


def plane_identity(family: Column) -> Column:
    """What decides which plane is drawn, without the seed ``c``; null where there is no partition."""
    rest = {k: tuple(f for f in v if f != "c") for k, v in CONSTANTS.items()}
    degree = F.coalesce(family["degree"], F.lit(2)).cast("string")
    key = F.concat(F.lit("["), F.concat_ws(", ", _text(partition_of(family)), degree, _constants(family, {k: v for k, v in rest.items() if v})), F.lit("]"))
    return F.when(partition_of(family).isNotNull(), key)


def sorted_map(settings: Column) -> Column:
    """JSON text of a map of texts in the order of its keys."""
    pairs = F.transform(F.array_sort(F.map_entries(settings)), lambda e: F.concat(_text(e["key"]), F.lit(": "), _text(e["value"])))
    return F.concat(F.lit("{"), F.array_join(pairs, ", "), F.lit("}"))


def render_key(place: Column, mode: Column, settings: Column, curve: Column, colormap: Column, recipe: Column) -> Column:
    """Identity of a finished render; null if any part, or any key of the recipe (a map of texts), is missing."""
    parts = [place, mode, settings, curve, colormap, recipe]
    whole = reduce(lambda a, b: a & b, [p.isNotNull() for p in parts] + [F.map_contains_key(recipe, k) for k in RECIPE])
    return F.when(F.coalesce(whole, F.lit(False)), F.concat_ws(" | ", place, mode, sorted_map(settings), curve, colormap, sorted_map(recipe)))


def normal_recipe(gamma: Column, cycles: Column, phase: Column, reverse: Column, mirror: Column, transfer: Column, rolloff: Column) -> Column:
    """The palette pass with its defaults filled in."""
    number = lambda c, d: F.coalesce(c.cast("double"), F.lit(d))
    flag = lambda c: F.coalesce(c.cast("boolean"), F.lit(False))
    return F.struct(
        number(gamma, 1.0).alias("gamma"), number(cycles, 1.0).alias("cycles"), number(phase, 0.0).alias("phase"), flag(reverse).alias("reverse"), flag(mirror).alias("mirror"),
        F.coalesce(transfer, F.lit("value")).alias("transfer"), F.coalesce(rolloff, F.lit("none")).alias("rolloff"),
    )


def passes_gates(fate: Column) -> Column:
    return F.coalesce(fate.isin(*PASSING), F.lit(False))


def acts(score: Column, cut: float) -> Column:
    """At or above a cut; a missing score is not."""
    return F.coalesce(score >= cut, F.lit(False))


def clears(score: Column, cut: float) -> Column:
    """At or above a cut; null for a missing score."""
    return score >= cut


def is_admitted(fate: Column, score: Column) -> Column:
    return passes_gates(fate) & acts(score, GOOD_FLOOR)


def good_class(score: Column, great: Column) -> Column:
    """4 or 3 of a score over the floor, by the chance of the top class; null below the floor."""
    return F.when(acts(score, GOOD_FLOOR), F.when(acts(great, GREAT_CUT), 4).otherwise(3))


def score_band(score: Column) -> Column:
    """0 to 4 by the edges 0.05, 0.2, 0.5, 0.8; anything out of range is the last, null has none."""
    return F.when(score.isNull(), F.lit(None)).when((score < 0) | (score >= 1.01), 4).when(score < 0.05, 0).when(score < 0.2, 1).when(score < 0.5, 2).when(score < 0.8, 3).otherwise(4)


def depth_band(width: Column, low: float, high: float) -> Column:
    """Thirds, equal in logarithm, of the widths from ``low`` to ``high``; null outside."""
    share = (F.ln(width) - F.ln(F.lit(low))) / (F.ln(F.lit(high)) - F.ln(F.lit(low)))
    return F.when((width >= low) & (width <= high), F.when(share < 1 / 3, "deep").when(share < 2 / 3, "middle").otherwise("shallow"))


def label_fault(schema: Column, batch: Column, score: Column, origin: Column, recorded_at: Column, key: Column) -> Column:
    """Why a label row can't be stored, the first reason; null if it can."""
    return (
        F.when(~F.coalesce(schema == 1, F.lit(False)), "schema")
        .when(F.coalesce(batch, F.lit("")) == "", "batch")
        .when(score.isNotNull() & ~score.isin(1, 2, 3, 4), "score")
        .when(~F.coalesce((origin == "human") | origin.startswith("rule:"), F.lit(False)), "origin")
        .when(recorded_at.isNull(), "recorded_at")
        .when(key.isNull(), "identity")
    )


def is_keeper(score: Column, origin: Column | None = None) -> Column:
    """A label of 3 or more; a human's, where the origin counts."""
    good = acts(score, 3)
    return good if origin is None else good & F.coalesce(origin == "human", F.lit(False))


def served_by_rule(interior: Column, limit: float = INTERIOR_RULE) -> Column:
    """Whether a rule answers a unit; one without the statistic is served to a person."""
    return F.coalesce(interior >= limit, F.lit(False))


def release_verdict(seated: Column, picture: Column) -> Column:
    return F.when(~seated, "passed_over").when(picture.isNull(), "killed").otherwise("released")


def already_says(score: Column, origin: Column, batch: Column, other_score: Column, other_origin: Column, other_batch: Column) -> Column:
    return score.eqNullSafe(other_score) & origin.eqNullSafe(other_origin) & batch.eqNullSafe(other_batch)


def digest_name(*parts: Column, length: int = 16) -> Column:
    """First digits of the SHA-256 of the parts' JSON array."""
    return F.substr(F.sha2(F.to_json(F.array(*parts)), 256), F.lit(1), F.lit(length))


def date_stamp(at: Column) -> Column:
    """UTC, ISO 8601, to the second. ``at`` is a time without zone, in UTC."""
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def human_size(n: Column) -> Column:
    return F.format_string("%.2f GiB", n.cast("double") / float(1 << 30))


def human_time(seconds: Column) -> Column:
    s = F.floor(seconds).cast("long")
    return F.when(s < 60, F.format_string("%ds", s)).when(s < 3600, F.format_string("%dm %02ds", F.floor(s / 60), s % 60)).otherwise(F.format_string("%dh %02dm", F.floor(s / 3600), F.floor(s % 3600 / 60)))


def rehomed(path: Column, old: str, new: str) -> Column:
    """A path under ``old`` moved under ``new``; others stay."""
    inside = path.startswith(old.rstrip("/") + "/")
    return F.when(inside, F.concat(F.lit(new.rstrip("/")), F.substr(path, F.lit(len(old.rstrip("/")) + 1)))).otherwise(path)


def family_line(family: Column) -> Column:
    shown = [F.when(family[k].isNotNull(), F.concat(F.lit(f"{k}="), family[k][0], F.lit(","), family[k][1])) for k in ("c", "p", "z_prev")]
    return F.concat_ws(" ", family["kind"], F.when(F.coalesce(family["degree"], F.lit(2)) != 2, F.concat(F.lit("d"), family["degree"].cast("string"))), *shown)


def viewport_line(viewport: Column) -> Column:
    return F.concat_ws(" ", viewport["center_re"], viewport["center_im"], F.concat(F.lit("w="), viewport["width"]))
