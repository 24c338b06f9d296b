import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import near_dedup
from tessera.llm.components import components, group_by_links
from tessera.llm.scratch import Scratch
from tests.llm.data import documents, empty, rows


def brute(data, threshold=0.85):
    sets = {}
    for r in data:
        w = (r[1] or "").encode().lower().split()
        s = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
        sets.setdefault(r[0], []).append(s)
    parent = {i: i for i in sets if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(parent)
    for a in ids:
        for b in ids:
            if a < b and any(s and t and len(s & t) >= threshold * len(s | t) - 1e-12 for s in sets[a] for t in sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_equals_brute_force(spark):
    rng = random.Random(5)
    data = rows()
    base = data[0][1].split(" ")
    for k in range(40):  # copies at all distances
        w = list(base)
        for _ in range(k // 4):
            w[rng.randrange(len(w))] = f"w{rng.randrange(9)}"
        data.append((100 + k, " ".join(w), "en", "s", 1, "k", 1, "c", 1))
    got = near_dedup.near_duplicates(spark.createDataFrame(data, documents(spark).schema)).collect()
    want = brute(data)
    assert len(got) == len(data)
    for r in got:
        assert r.component_id == want.get(r.doc_id)
        assert r.kept == (r.doc_id is None or r.doc_id == r.component_id)


def test_contained_documents(spark):
    """One set within another on both sides of the sketch's size, against brute force."""
    rng = random.Random(8)
    data = []
    for k in range(300):
        small = rng.randint(110, 136)
        words = [f"w{rng.randrange(10**9)}" for _ in range(min(int(small / 0.85), 160) + 4)]
        data += [(2 * k, " ".join(words[: small + 4])), (2 * k + 1, " ".join(words))]
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    lost = [k for k in range(300) if got[2 * k + 1] != 2 * k]
    assert not lost


def test_hub_near_nothing(spark):
    """The smallest id of a list is near no other, two others are near each other."""
    members = spark.createDataFrame([(1, 10, 0), (1, 20, 50), (1, 30, 51)], "key long, id long, at int")

    def payload(ids):
        return ids.join(members.select("id", F.col("at").alias("place")).distinct(), "id")

    got = group_by_links(members, payload, lambda a, b: F.abs(F.col(f"{a}place") - F.col(f"{b}place")) < 2, lambda a, b: F.abs(F.col(f"{a}at") - F.col(f"{b}at")) < 2, Scratch(spark, "hub"))
    assert {(r.id, r.component) for r in got.collect()} == {(20, 20), (30, 20)}


def test_sizes(spark):
    got = near_dedup.near_duplicates(spark.createDataFrame([(1, "a b c d e f", 0), (2, "a b", 0), (3, " ", 0), (4, None, 0), (5, "A B", 0)], "doc_id long, text string, vals int"))
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == [(1, 2, 1), (2, 1, 2), (3, 0, 3), (4, 0, 4), (5, 1, 2)]


def test_stage_keeps_one(spark):
    docs = documents(spark, extra=False)
    out = near_dedup.drop_near_duplicates(docs)
    assert out.columns == docs.columns
    assert not {14, 15, 16, 18} & {r.doc_id for r in out.collect()}


def test_empty(spark):
    assert near_dedup.near_duplicates(empty(spark)).count() == 0


@pytest.mark.parametrize("local", [0, 10**6])
def test_components(spark, monkeypatch, local):
    monkeypatch.setattr("tessera.llm.components.LOCAL", local)
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (7, 7), (50, 20), (None, 3)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "test")).collect()}
    assert all(got[i] == 0 for i in [*range(41), 50]) and got[102] == 100 and 7 in got and None not in got
    pairs = spark.createDataFrame([((2, 1), (1, 9)), ((1, 9), (1, 2)), ((5, 5), (6, 6))], "a struct<h1: long, h2: long>, b struct<h1: long, h2: long>")
    got = {tuple(r.id): tuple(r.component) for r in components(pairs, Scratch(spark, "test")).collect()}
    assert got == {(2, 1): (1, 2), (1, 9): (1, 2), (1, 2): (1, 2), (5, 5): (5, 5), (6, 6): (5, 5)}


def test_columns_keep_their_names(spark):
    names = ["_gone", "_doc", "_c", "key", "id", "component", "n_shingles"]
    docs = spark.createDataFrame([(i, "one text that is there twice in all", *names) for i in (1, 2)], ["doc_id", "text", *names])
    out = near_dedup.drop_near_duplicates(docs).collect()
    assert len(out) == 1 and [out[0][n] for n in names] == names


def test_long_list_without_links(spark):
    """More texts than hubs that share a passage, are near in pairs only, and so have to be found past all hubs."""
    rng = random.Random(12)
    passage = [f"p{k}" for k in range(30)]
    data = []
    for i in range(80):
        own = [f"w{rng.randrange(10**9)}" for _ in range(34)]
        data += [(2 * i, " ".join(passage + own)), (2 * i + 1, " ".join(passage + own[:-1] + ["other"]))]
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert got == brute(data)
    assert all(got[2 * i + 1] == 2 * i for i in range(80))


def test_prefix_shares_a_value():
    """Of any two linked sets the first values share one, in a common order, at all sizes."""
    rng = random.Random(13)
    for _ in range(3000):
        n = rng.randint(1, 60)
        both = rng.randint(0, n)
        a = set(range(n))
        b = set(range(both)) | {100 + k for k in range(rng.randint(0, 12))}
        for threshold in (0.8, 0.85, 0.5):
            if b and len(a & b) >= threshold * len(a | b):
                order = lambda s: sorted(s, key=lambda x: hash((x, 7)))
                size = lambda s: int(near_dedup.prefix_length(np.array([len(s)]), threshold)[0])
                assert set(order(a)[: size(a)]) & set(order(b)[: size(b)])


def test_large_sets_are_bounded_before_they_move(spark, monkeypatch):
    """Of long texts that share a passage, only the linked ones have all their shingles moved for a comparison."""
    rng = random.Random(21)
    seen = []

    def grouped(lists, payload, linked, near, scratch, bound=None):
        def counted(ids):
            wide = payload(ids)
            if "parity" in wide.columns:
                both = wide.alias("a").crossJoin(wide.alias("b")).where("a.id < b.id")
                flat = both.select(*[F.col(f"{s}.{c}").alias(f"{p}_{c}") for s, p in (("a", "l"), ("b", "r")) for c in wide.columns])
                seen.extend((r.l_id, r.r_id) for r in flat.where(bound[1]("l_", "r_")).collect())
            return wide

        return group_by_links(lists, counted, linked, near, scratch, bound=bound)

    monkeypatch.setattr(near_dedup, "group_by_links", grouped)
    passage = [f"p{k}" for k in range(900)]
    data = []
    for i in range(6):
        own = [f"w{rng.randrange(10**9)}" for _ in range(700)]
        data += [(2 * i, " ".join(passage + own)), (2 * i + 1, " ".join(passage + own[:-20] + ["other"] * 9))]
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert got == brute(data) and all(got[2 * i + 1] == 2 * i for i in range(6))
    assert set(seen) == {(2 * i, 2 * i + 1) for i in range(6)}


def test_workers_hold_little(monkeypatch):
    """Sets are made of a few texts at a time, and a task that ends gives its memory back."""
    import pyarrow as pa

    from tessera.llm import near_dedup, words

    calls = []
    monkeypatch.setattr(words, "give_back", lambda: calls.append(1))
    batch = pa.RecordBatch.from_arrays([pa.array(range(1024)), pa.array(["a b c d e f " * 300] * 1024)], ["id", "text"])
    for run, _ in (near_dedup._sets(5, 0.85, "id"), near_dedup._compared(5, "id")):
        sizes = [x.num_rows for x in run(iter([batch]))]
        assert sum(sizes) == 1024 and max(sizes) * 3600 <= 1 << 20
    assert len(calls) == 2


def test_tasks_take_one_worker(spark, monkeypatch):
    """No written table runs one Python function on the rows of another, sets of frequent values included."""
    made = []

    class Seen(near_dedup.Scratch):
        def keep(self, frame):
            made.append(frame._jdf.queryExecution().optimizedPlan().toString())
            return super().keep(frame)

    monkeypatch.setattr(near_dedup, "Scratch", Seen)
    monkeypatch.setattr(near_dedup, "FREQUENT", 2)
    shared = [f"p{k}" for k in range(60)]
    data = [(i, " ".join(shared + [f"w{i}"])) for i in range(6)] + [(6, "some other words that nothing else has")]
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert got == brute(data)
    # Sets of frequent values alone were ordered as a whole.
    assert sum("MapInArrow" in p for p in made) >= 4
    assert max(p.count("MapInArrow") for p in made) == 1
