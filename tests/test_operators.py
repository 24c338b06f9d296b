import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import colour, kernel, scalars
from tessera.operators import draws, joins, measure, resolve, select, spatial, supply
from tessera.operators.scratch import Scratch


def test_water_fill_equals_rounds(spark):
    rng = random.Random(1)
    for n in (1, 3, 7, 30):
        weights = [rng.choice([0.0, rng.random(), 5 * rng.random()]) for _ in range(n)]
        got = {r.p: r.share for r in supply.water_fill(spark.createDataFrame([(f"{i:02}", w) for i, w in enumerate(weights)], "p string, w double"), "p", "w").collect()}
        if sum(weights) == 0 or n * 0.05 >= 1:
            want = [1 / n] * n
        else:
            fixed: set = set()
            while True:
                left, total = 1 - 0.05 * len(fixed), sum(w for i, w in enumerate(weights) if i not in fixed)
                low = {i for i, w in enumerate(weights) if i not in fixed and left * w / total < 0.05}
                if not low:
                    break
                fixed |= low
            want = [0.05 if i in fixed else left * w / total for i, w in enumerate(weights)]
        assert all(math.isclose(got[f"{i:02}"], w, abs_tol=1e-9) for i, w in enumerate(want))


def test_even_capped_gives_all(spark):
    rng = random.Random(2)
    for budget in (0, 5, 23, 1000):
        caps = [(f"{i:02}", rng.randint(0, 9)) for i in range(8)]
        got = {r.p: r.slots for r in supply.even_capped(spark.createDataFrame(caps, "p string, cap long"), "p", "cap", budget).collect()}
        assert sum(got.values()) == min(budget, sum(c for _, c in caps))
        assert all(got[p] <= c for p, c in caps)
        open_ = [got[p] for p, c in caps if got[p] < c]
        assert not open_ or max(got.values()) - min(open_) <= 1


def test_largest_deficit_by_hand():
    picks = supply.largest_deficit({"a": 3.0, "b": 1.0, "c": 0.0}, 8)
    assert picks.count("a") == 6 and picks.count("b") == 2 and "c" not in picks
    assert supply.largest_deficit({"a": 1.0, "b": 1.0}, 2) == ["b", "a"]
    assert supply.largest_deficit({"a": 1.0}, 5, {"a": 2}) == ["a", "a"]
    # Worked by hand: shares stay those of all weights when a is at its cap.
    assert "".join(supply.largest_deficit({"a": 5.0, "b": 3.0, "c": 2.0}, 12, {"a": 2, "b": 9, "c": 9})) == "abcabcbcbbcb"
    # Caps that don't name a partition leave it nothing.
    assert supply.largest_deficit({"a": 1.0, "b": 1.0}, 3, {"a": 9}) == ["a", "a", "a"]
    assert supply.largest_deficit({}, 3) == [] and supply.largest_deficit({"a": 0.0}, 3) == []


def test_guarantees_by_hand():
    assert supply.guaranteed_slots({"a": 100.0, "b": 1.0, "c": 1.0}, 3, None, {"b", "c"}) == {"a": 1, "b": 1, "c": 1}
    # A floor, not a bonus: one that the rule seats gains nothing.
    assert supply.guaranteed_slots({"a": 2.0, "b": 1.0}, 3, None, {"a"}) == supply.guaranteed_slots({"a": 2.0, "b": 1.0}, 3)
    # No weight, no room, or no such name: nothing to guarantee.
    assert supply.guaranteed_slots({"a": 1.0, "b": 0.0}, 2, None, {"b", "z"}) == {"a": 2, "b": 0}
    assert supply.guaranteed_slots({"a": 1.0, "b": 1.0}, 3, {"a": 2, "b": 0}, {"b"}) == {"a": 2, "b": 0}
    with pytest.raises(ValueError):
        supply.guaranteed_slots({"a": 1.0, "b": 1.0}, 1, None, {"a", "b"})
    assert supply.guaranteed_slots({"a": 1.0}, 0) == {"a": 0}


def test_slots_and_attempts():
    slots, source = supply.batch_slots({"a": 0.6, "b": 0.3, "c": 0.1}, {"a": 90.0, "b": 10.0}, {"a": 9, "b": 9, "c": 9}, 4)
    assert source == "share_gap" and slots == {"a": 0, "b": 3, "c": 1}
    slots, source = supply.batch_slots({"a": 0.5, "b": 0.5}, {"a": 5.0, "b": 5.0}, {"a": 1, "b": 9}, 3)
    assert source == "intent" and slots == {"a": 1, "b": 2}
    slots, _ = supply.batch_slots({"a": 1.0}, {}, {"a": 5, "b": 5, "c": 5}, 2, claimants=["b", "c"], capped=["c"])
    assert slots["b"] == 0 or slots["b"] == 1
    assert supply.head_split(5, 0.5) == {"first": 3, "second": 2} and supply.head_split(3, 2.0) == {"first": 0, "second": 3}
    assert supply.guarantee_heads(["c", "a", "b"], {"first": 1, "second": 1}) == ({"a": "first", "b": "second"}, ["c"])
    assert supply.truncated({"a": 3, "b": 1}, 9) == {"a": 3, "b": 1} and supply.truncated({"a": 3, "b": 1}, 2) == {"a": 2, "b": 0}
    plan = supply.attempt_cells({"a": 9, "b": 2, "c": 0}, {"a": 3.0, "b": 1.0, "c": 1.0}, 4, 0.5, None, ["b"])
    assert {(h, p) for h, p, _ in plan} <= {(h, p) for h in ("first", "second") for p in "ab"}
    for h in ("first", "second"):
        for p in "ab":
            assert [r for a, b, r in plan if (a, b) == (h, p)] == list(range(sum((a, b) == (h, p) for a, b, _ in plan)))


def greedy(candidates, slots, bar, used, cap=2):
    log, seated = [], {}
    for part, (n, limit, owed) in slots.items():
        budget = n if limit is None else min(n, limit)
        if owed and n >= 1:
            budget = max(budget, 1)
        taken = 0
        for rank, (i, p, g, s) in enumerate(sorted((c for c in candidates if c[1] == part), key=lambda c: (-c[3], c[0]))):
            if taken >= budget:
                break
            why = "below_bar" if s < bar else "cluster_cap" if used.get(g, 0) >= cap else None
            if why is None:
                used[g] = used.get(g, 0) + 1
                taken += 1
            log.append((i, rank, why))
        seated[part] = taken
    return log, seated


def test_release_equals_greedy(spark):
    rng = random.Random(3)
    slots = {"p": (5, None, False), "q": (4, 2, False), "r": (3, 0, True), "s": (0, None, True)}
    frame = spark.createDataFrame([(k, *v) for k, v in slots.items()], "part string, slots int, cap int, guaranteed boolean")
    used: dict = {}
    picks = None
    # Two passes: the cap of a group is one over both.
    for turn in range(2):
        rows = [(f"{turn}{i:03}", p, f"{p}{rng.randint(0, 4)}", rng.randint(0, 20) / 20) for i in range(60) for p in [rng.choice("pqrst")]]
        before = spark.createDataFrame(list(used.items()) or [("none", 0)], "group string, n int")
        candidates = spark.createDataFrame(rows, "id string, part string, group string, score double")
        log = select.release(candidates, frame, bar=0.3, used=before)
        want, seated = greedy(rows, slots, 0.3, used)
        got = log.collect()
        assert sorted((r.id, r["rank"], r.skipped) for r in got) == sorted(want)
        fills = {r.part: r for r in select.fills(log, candidates, frame).collect()}
        assert {k: r.seated for k, r in fills.items()} == {k: n for k, n in seated.items() if slots[k][0]}
        for k, r in fills.items():
            if r.unfilled == 0:
                assert r.reason is None
            elif r.seated >= r.budget:
                assert r.reason == "supply_cap"
            else:
                assert r.reason == ("below_bar" if r.below_bar else "cluster_cap" if r.cluster_cap else "no_candidates")
        sources = [r.slot_source for r in got if r.part == "r" and r.picked]
        assert sources[:1] in (["guarantee"], [])
        picks = got
    assert picks


def test_auc_edges(spark):
    make = lambda *rows: spark.createDataFrame(rows, "score double, label int")
    assert measure.auc(make((0.5, 1), (0.5, 0)), "score", "label").first().auc == 0.5
    assert measure.auc(make((0.5, 1), (0.7, 1)), "score", "label").first().auc is None
    assert measure.auc(make((0.9, 1), (0.1, 0), (None, 0)), "score", "label").first().auc == 1.0


def test_bootstrap_is_repeatable(spark):
    rows = spark.createDataFrame([(g, float(g % 5) + k / 10) for g in range(40) for k in range(3)], "g long, v double")
    a, b = (measure.cluster_bootstrap(rows, "g", "v", 400).first() for _ in "ab")
    assert a == b and a.low < 2.1 < a.high and a.draws == 400


def test_latest_and_first_writer_nulls(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), (None, 3, "y"), (None, 4, "z")], "k string, t long, v string")
    got = resolve.latest(rows, ["k"], [rows["t"]]).collect()
    assert [(r.k, r.t, r.v, r.superseded) for r in got] == [("a", 2, None, 1)]
    assert resolve.first_writer(rows, rows["k"], [rows["t"]]).count() == 3


def test_density_and_groups_equal_brute_force(spark):
    rng = random.Random(4)
    pts = [(i, rng.choice("pq"), rng.random(), rng.random(), 10 ** rng.uniform(-2, 0)) for i in range(150)]
    frame = spark.createDataFrame(pts, "id long, part string, x double, y double, width double")
    got = {r.id: r.density for r in spatial.disc_density(frame, frame, "part").collect()}
    assert got == {a[0]: sum(a[1] == b[1] and (a[2] - b[2]) ** 2 + (a[3] - b[3]) ** 2 <= (0.3 * b[4]) ** 2 for b in pts) for a in pts}
    pairs = {(r.a, r.b) for r in spatial.neighbour_edges(frame, "part").collect()}
    want = {(a[0], b[0]) for a, b in itertools.combinations(pts, 2) if a[1] == b[1] and max(a[4], b[4]) <= 1.5 * min(a[4], b[4]) and math.hypot(a[2] - b[2], a[3] - b[3]) <= 0.5 * min(a[4], b[4])}
    assert pairs == want and want
    chain = spark.createDataFrame([(i, i + 1) for i in range(30)], "a long, b long")
    assert {r.component for r in spatial.components(chain, Scratch(spark, "test")).collect()} == {0}


def slow_orbit(family, point, limit):
    z, before, c, d = (x[0] for x in family.seed(np.array([point])))
    last = 0j
    for n in range(1, limit + 1):
        d, last = family.slope(np.array([z]), d, last)[0], d
        z, before = family.step(np.array([z]), before, c)[0], z
        if abs(z) > 65536:
            return n + 1 - math.log(math.log(abs(z)) / math.log(65536)) / math.log(family.degree), 2 * abs(z) * math.log(abs(z)) / abs(d)
    return None


def test_kernel():
    for family in (kernel.Family("multibrot", 2), kernel.Family("multibrot", 3), kernel.Family("julia", 2, -0.4 + 0.6j), kernel.Family("phoenix", 2, 0.5667, -0.5), kernel.Family("multibrot", 2.5)):
        points = kernel.grid(0.1 + 0.2j, 3.0, 9, 7)
        got = kernel.gather(points, family, 60, ("smooth", "de"))
        for p, s, e, inside in zip(points.ravel(), got["smooth"].ravel(), got["de"].ravel(), got["interior"].ravel(), strict=True):
            want = slow_orbit(family, p, 60)
            assert (want is None) == inside == bool(np.isnan(s))
            assert want is None or (math.isclose(s, want[0], rel_tol=1e-9) and math.isclose(e, want[1], rel_tol=1e-6))
    assert math.isnan(colour.nearest_rank(np.zeros(0), 0.5)) and colour.nearest_rank(np.array([3.0, 1.0, 2.0]), 0.5) == 2.0
    assert kernel.occupancy(np.zeros((54, 96, 3), np.uint8)) == 0.0


def test_gates_in_order(spark):
    """Each gate's side: what is refused at the threshold, and what passes."""
    m = kernel.Family("multibrot", 2)
    assert kernel.frame(0j, 0.01, m, 64, 36, 50)["fate"] == "interior_cap"
    assert kernel.frame(1e6 + 1e6j, 0.01, m, 64, 36, 50)["fate"] == "instant_escape"
    far = kernel.frame(0.6 + 0j, 1e-4, m, 64, 36, 200)
    assert far["fate"] == "flat" and far["median"] >= 3 and far["spread"] < 20 and far["occupancy"] is None
    good = kernel.frame(-0.743643 + 0.131825j, 0.002, m, 96, 54, 2000)
    assert good["spread"] >= 20 and good["fate"] in ("survived", "occupancy_floor")


def test_colours():
    rgb = np.random.default_rng(1).random((50, 3))
    assert np.allclose(colour.from_oklab(colour.oklab(rgb)), rgb, atol=1e-6) and np.allclose(colour.to_linear(colour.to_encoded(rgb)), rgb)
    stops = [(0.0, (0, 0, 0)), (1.0, (255, 255, 255))]
    table = colour.bake(stops)
    assert np.allclose(colour.lookup(table, np.array([0.0, 1.0, 2.0])), [[0] * 3, [1] * 3, [1] * 3], atol=1e-6)
    fold = colour.bake(stops, mirror=True)
    assert np.allclose(fold[0], fold[-1], atol=1e-9) and np.allclose(fold[2048], 1, atol=1e-2)
    assert np.allclose(colour.bake(stops, reverse=True), table[::-1])
    for bad in ([(0.0, (0, 0, 0))],):
        with pytest.raises(ValueError):
            colour.bake(bad)
    with pytest.raises(ValueError):
        colour.bake(stops, mirror=True, cyclic=True)
    flat = np.full((20, 30, 3), 0.25)
    assert (colour.resampled(flat, 10, 5) == colour.to_bytes(flat[:1, :1])).all()
    assert len(colour.densified(stops)) == 9 and len(kernel.MODES) == 19
    assert all(np.isfinite(kernel.drawn(kernel.grid(-0.5 + 0j, 3, 24, 16), kernel.Family("multibrot", 2), 40, mode)).all() for mode in kernel.MODES.values())


def test_kept_apart_equals_one_after_the_other(spark):
    rng = random.Random(7)
    pts = [(i, rng.choice("pq"), rng.randint(0, 30), rng.random(), rng.random()) for i in range(300)]
    frame = spark.createDataFrame(pts, "id long, part string, at int, x double, y double")
    for strict in (False, True):
        kept = []
        for p in sorted(pts, key=lambda p: (p[2], p[0])):
            gaps = [math.hypot(p[3] - k[3], p[4] - k[4]) for k in kept if k[1] == p[1]]
            if all(g > 0.08 if strict else g >= 0.08 for g in gaps):
                kept.append(p)
        got = draws.kept_apart(frame, "part", "at", 0.08, Scratch(spark, "test"), strict)
        assert {r.id for r in got.collect()} == {k[0] for k in kept}
    assert draws.kept_apart(frame.where("id < 0"), "part", "at", 0.08, Scratch(spark, "test")).count() == 0


def test_nearest_far_and_none(spark):
    pts = [(i, "p", float(i % 10), float(i // 10)) for i in range(60)] + [(900, "p", 500.0, 500.0), (901, "q", 0.0, 0.0)]
    frame = spark.createDataFrame(pts, "id long, part string, x double, y double")
    got = {r.id: r for r in draws.nearest(frame, frame.where("id in (0, 7, 33)"), "part").collect()}
    for i, part, x, y in pts:
        want = min(((math.hypot(x - a[2], y - a[3]), a[0]) for a in pts if a[0] in (0, 7, 33) and a[1] == part), default=None)
        assert (got[i].distance, got[i].nearest) == ((None, None) if want is None else pytest.approx(want))


def test_tones():
    gray = np.repeat(np.linspace(0, 255, 400).astype(np.uint8)[:, None, None], 3, axis=2).repeat(10, axis=1)
    t = colour.tones(gray)
    assert t["neutral"] == 1.0 and t["black"] is not None and t["black"] < 0.1 < t["middle"] < t["white"] <= 1.0001
    # In band already: the exact identity.
    same = colour.tone_curve(t, {k: (t[k] - 0.01, t[k] + 0.01) for k in ("black", "white", "middle")})
    x = np.linspace(0, 1, 50)
    assert math.isclose(same["exponent"], 1.0) and np.allclose(colour.toned(x, same), x)
    # Out of band: ends and middle go to the nearest edge of theirs.
    curve = colour.tone_curve(t, {"white": (0.8, 0.9), "middle": (0.62, 0.65)})
    assert np.allclose(colour.toned(np.array([t["white"], t["middle"]]), curve), [0.9, 0.62], atol=1e-6)
    assert (np.diff(colour.toned(x, curve)) >= -1e-12).all()
    assert colour.tone_curve(colour.tones(np.full((20, 20, 3), 90, np.uint8)), {}) is None
    red = np.zeros((40, 40, 3), np.uint8)
    red[..., 0] = 200
    assert colour.tones(red)["black"] is None


def test_period_candidates():
    # Near the nucleus of period 3 and that of period 2.
    assert 3 in kernel.period_candidates(-0.1225611 + 0.7448618j, 2) and 2 in kernel.period_candidates(-1.0001 + 0j, 2)
    assert kernel.period_candidates(9 + 0j, 2) == []


def test_closest_pair_of_two_points_and_odd_ones(spark):
    pts = [(1, "two", 0.0, 0.0), (2, "two", 3.0, 4.0), (1, "one", 1.0, 1.0), (1, "same", 0.0, 0.0), (1, "same", 0.0, 0.0), (2, "same", 6.0, 8.0), (1, "null", None, 1.0), (2, "null", 1.0, 1.0), (1, None, 0.0, 0.0), (2, None, 0.0, 0.0)]
    frame = spark.createDataFrame(pts, "id long, part string, x double, y double")
    got = {r.part: r.distance for r in joins.closest_pair(frame, "part").collect()}
    assert got == {"two": 5.0, "one": math.inf, "same": 10.0, "null": math.inf, None: math.inf}


def test_colours_come_back_from_oklab(spark):
    rows = spark.range(256 * 8).select(*[(F.col("id") * k % 256 / 255).alias(n) for n, k in (("r", 1), ("g", 7), ("b", 13))])
    lab = rows.select("*", scalars.oklab(*[scalars.linear(F.col(n)) for n in "rgb"]).alias("o"))
    back = lab.select("r", "g", "b", scalars.from_oklab(F.col("o.l"), F.col("o.a"), F.col("o.b")).alias("c"))
    off = [F.max(F.abs(scalars.encoded(F.greatest(F.col(f"c.{n}"), F.lit(0.0))) - F.col(n))) for n in "rgb"]
    assert max(back.agg(*off).first()) < 1e-12


def test_kept_apart_in_dense_places(spark):
    """Many points in each other's reach, in an order along the plane, over several tiles, and odd ones."""
    rng = random.Random(9)
    pts = [(i, "p", i // 50, (i % 7) * 0.3 + rng.random() * 0.01, rng.choice([0.0, rng.random() * 9])) for i in range(1500)]
    pts += [(2000 + i, "p", i, i * 0.01 - 3.0, -1.0) for i in range(900)]
    odd = [(5000, None, 1, 0.0, 0.0), (5001, "p", 1, None, 0.0), (5002, "p", 1, math.nan, 0.0), (5003, "p", 1, math.inf, 0.0)]
    frame = spark.createDataFrame(pts + odd, "id long, part string, at int, x double, y double")
    for strict in (False, True):
        kept = []
        for p in sorted(pts, key=lambda p: (p[2], p[0])):
            if all((p[3] - k[3]) ** 2 + (p[4] - k[4]) ** 2 > 0.05**2 or (not strict and (p[3] - k[3]) ** 2 + (p[4] - k[4]) ** 2 == 0.05**2) for k in kept):
                kept.append(p)
        got = draws.kept_apart(frame, "part", "at", 0.05, Scratch(spark, "test"), strict)
        assert got.columns == frame.columns
        assert sorted(r.id for r in got.collect()) == sorted(k[0] for k in kept) + [5000, 5001, 5002, 5003]


def test_all_modes_come_from_one_pass(monkeypatch):
    points, family = kernel.grid(-0.5 + 0.1j, 3, 24, 16), kernel.Family("julia", 2, -0.4 + 0.6j)
    alone = {name: kernel.drawn(points, family, 40, mode) for name, mode in kernel.MODES.items()}
    passes, gather = [], kernel.gather
    monkeypatch.setattr(kernel, "gather", lambda *a: passes.append(1) or gather(*a))
    got = dict(kernel.all_drawn(points, family, 40, kernel.MODES))
    assert len(passes) == 1 and list(got) == list(kernel.MODES)
    assert all(np.array_equal(got[name], alone[name]) for name in got)


def test_kept_apart_rules_out_before_points_move(spark, monkeypatch):
    """What the first points keep rules out most others where they are read; the result is that of one after the other."""
    rng = random.Random(11)
    monkeypatch.setattr(draws, "LEAST", 100)
    seen, decided = [], draws._all_decided
    monkeypatch.setattr(draws, "_all_decided", lambda left, *a: seen.append(left.count()) or decided(left, *a))
    pts = [(i, rng.choice([1.0, 2.0, math.nan]) if i % 50 == 0 else 1.0, None if i == 77 else (i * 7) % 1999, rng.random() * 2 - 1, rng.random()) for i in range(2000)]
    frame = spark.createDataFrame(pts, "id long, part double, at int, x double, y double")
    for strict, sent, moved in ((False, 10**6, 1200), (True, 10**6, 1200), (True, 0, 2200)):
        monkeypatch.setattr(draws, "SENT", sent)
        seen.clear()
        kept = []
        for p in sorted(pts, key=lambda p: (-1 if p[2] is None else p[2], p[0])):
            gaps = [(p[3] - k[3]) ** 2 + (p[4] - k[4]) ** 2 for k in kept if k[1] == p[1]]
            if all(g > 0.2**2 if strict else g >= 0.2**2 for g in gaps):
                kept.append(p)
        got = draws.kept_apart(frame, "part", "at", 0.2, Scratch(spark, "test"), strict)
        assert got.columns == frame.columns and sorted(r.id for r in got.collect()) == sorted(k[0] for k in kept)
        assert len(seen) == 2 and sum(seen) <= moved


def test_orbits_in_parts_and_only_escaping_ones_in_full(monkeypatch):
    """What only escaped points have isn't worked out for those that never escape, and parts give what the whole gives."""
    points, want = kernel.grid(-0.5 + 0.1j, 3, 40, 24), ("smooth", "discrete", "stripe", "velocity", "de", "itinerary", "curvature")
    traps = ({**kernel.MODES["direct_trap_ring"], "table": kernel.GRADIENT},)
    for family in (kernel.Family("multibrot", 2), kernel.Family("julia", 2, -0.4 + 0.6j), kernel.Family("phoenix", 2, 0.5667 + 0j, -0.5 + 0j)):
        whole = kernel.gather(points, family, 60, want, kernel.LATTICE, traps)
        assert 0 < whole["interior"].mean() < 1
        with monkeypatch.context() as m:
            m.setattr(kernel, "PART", 100)
            parts = kernel.gather(points, family, 60, want, kernel.LATTICE, traps)
        assert whole.keys() == parts.keys() and all(np.allclose(whole[k], parts[k], rtol=1e-12, atol=1e-12, equal_nan=True) for k in whole)
        with monkeypatch.context() as m:
            terms, push = [], kernel._Mean.push
            m.setattr(kernel._Mean, "push", lambda self, at, term, *a: terms.append(len(term)) or push(self, at, term, *a))
            stripe = kernel.gather(points, family, 60, ("stripe", "discrete"))
        assert sum(terms) == np.nansum(stripe["discrete"]) and np.array_equal(np.isnan(stripe["stripe"]), stripe["interior"])


def test_pair_spread_equals_all_pairs(spark, monkeypatch):
    """Groups in parts, copies, repeated ids, and vectors that are null, odd, huge or of another length."""
    rng = random.Random(5)
    rows = [(g, i, [rng.gauss(0, 1) for _ in range(6)]) for g, n in ((1, 90), (2, 30), (3, 1)) for i in range(n)]
    rows += [(1, 200, rows[3][2]), (1, 5, [9.0] * 6), (1, 201, [x + 1e-7 for x in rows[4][2]]), (2, 77, None), (2, 78, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (2, 79, [1.0, 2.0])]
    rows += [(4, 1, [math.inf] * 6), (4, 2, [0.0] * 6), (4, 3, [math.nan] * 6), (4, 4, [1e200] * 6), (5, 1, None), (5, 2, [0.0] * 6), (None, 1, [0.0] * 6), (2, None, [0.0] * 6), (6, 1, [1e5] * 6), (6, 2, [1e5 + 1e-3] * 6)]
    frame = spark.createDataFrame(rows, "label int, vec_id long, embedding array<double>")
    a, b = (frame.select("label", F.col("vec_id").alias(i), F.col("embedding").alias(x)) for i, x in (("i", "x"), ("j", "y")))
    pairs = a.join(b, "label").where("i < j").withColumn("d", spatial.distance(F.col("x"), F.col("y")))
    want = {r[0]: r[1:] for r in pairs.groupBy("label").agg(F.min("d"), F.avg("d"), F.max("d"), F.count("*")).collect()}
    for whole, part, block in ((8192, 2**21, 1024), (20, 6, 1024), (20, 6, 7)):
        for name, value in (("WHOLE", whole), ("PART", part), ("ROWS", 5), ("COLUMNS", block)):
            monkeypatch.setattr(spatial, name, value)
        got = {r[0]: r[1:] for r in spatial.pair_spread(frame, "label", "vec_id", "embedding").collect()}
        assert got.keys() == want.keys()
        assert all(g == w or g == pytest.approx(w, rel=1e-11, abs=1e-9, nan_ok=True) for k in want for g, w in zip(got[k], want[k])), (got, want)


def test_palettes_are_compared_in_blocks(spark):
    from tessera.plans import registry

    plan = registry.QUERIES["palette_tightness"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "FlatMapGroupsInArrow" in plan and "zip_with" not in plan


def _points_and_pairs(seed, n=400):
    rng = random.Random(seed)
    at = lambda: rng.choice([rng.uniform(-3, 3), rng.gauss(0, 0.05), 0.25])
    pts = [(i, rng.choice("pq"), at(), at(), rng.choice([10 ** rng.uniform(-3, 0.5), 1.5 ** rng.randint(-9, 3), 0.3, 0.0])) for i in range(n)]
    pts += [(n + i, "p", i * 0.4, -7.0, 1.0) for i in range(150)]
    odd = [(9000, None, 0.0, 0.0, 1.0), (9001, "p", None, 0.0, 1.0), (9002, "p", math.nan, 0.0, 1.0), (9003, "p", math.inf, 0.0, 1.0), (9004, "p", 0.0, 0.0, None), (9005, "p", 0.0, 0.0, -1.0), (9006, "p", 0.0, 0.0, math.nan), (9007, "p", 1e300, -1e300, 1.0), (9008, "p", 1e300, -1e300, 1.0)]
    pairs = {(a[0], b[0]) for k, a in enumerate(pts) for b in pts[k + 1 :] if a[1] == b[1] and max(a[4], b[4]) <= 1.5 * min(a[4], b[4]) and math.sqrt((a[2] - b[2]) ** 2 + (a[3] - b[3]) ** 2) <= 0.5 * min(a[4], b[4])} | {(9007, 9008)}
    return pts + odd, pairs


def test_neighbours_across_tiles_bands_and_levels(spark):
    for seed in (1, 2):
        pts, pairs = _points_and_pairs(seed)
        got = spatial.neighbour_edges(spark.createDataFrame(pts, "id long, plane string, x double, y double, width double"), "plane")
        rows = [tuple(r) for r in got.collect()]
        assert len(pairs) > 500 and len(rows) == len(set(rows)) and set(rows) == pairs


def test_neighbours_move_points_once_and_no_pairs(spark):
    """Before, a point moved eleven times to cells, and all pairs were shuffled to be distinct."""
    frame = spark.range(3000).select("id", F.lit("p").alias("plane"), F.rand(1).alias("x"), F.rand(2).alias("y"), F.lit(0.02).alias("width"))
    assert spatial._tiled(frame, "plane", 1.5, 0.5).count() < 2 * 3000
    plan = spatial.neighbour_edges(frame, "plane")._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_neighbour_groups_equal_reachable_ids(spark, monkeypatch):
    linked, components = [], spatial.components
    monkeypatch.setattr(spatial, "components", lambda edges, *a: linked.append(edges.count()) or components(edges, *a))
    for seed, few in ((3, 0), (4, 10**6)):
        monkeypatch.setattr(spatial, "FEW", few)
        pts, pairs = _points_and_pairs(seed)
        least = {p[0]: p[0] for p in pts}
        while any(least[a] != least[b] for a, b in pairs):
            for a, b in pairs:
                least[a] = least[b] = min(least[a], least[b])
        got = spatial.neighbour_groups(spark.createDataFrame(pts, "id long, plane string, x double, y double, width double"), "plane", Scratch(spark, "test"))
        assert sorted(tuple(r) for r in got.collect()) == sorted(least.items())
    # Only points between tiles link groups, not all pairs.
    assert len(linked) == 1 and linked[0] < len(pairs)
