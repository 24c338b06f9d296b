import math
import random

import numpy as np
import pyarrow as pa

from tessera.llm import toxicity
from tests.llm.data import documents, empty, rows, words


def brute_segments(x):
    """All maximal segments by their definition: the best one, then the same left and right of it."""

    def best(a, b):
        top = None
        for i in range(a, b):
            s = 0.0
            for j in range(i, b):
                s += x[j]
                key = (s, -(j - i))
                if s > 1e-12 and (top is None or key > top[0]):
                    top = (key, i, j + 1)
        return top

    def split(a, b):
        t = best(a, b)
        return [] if t is None else split(a, t[1]) + [(t[1], t[2], t[0][0])] + split(t[2], b)

    return split(0, len(x))


def test_segments():
    rng = random.Random(8)
    for _ in range(200):
        x = np.array([rng.choice([-3.0, -1.5, -0.7, 0.9, 2.1, 4.3]) + rng.random() / 100 for _ in range(rng.randint(0, 18))])
        got, want = toxicity.segments(x), brute_segments(x)
        assert [g[:2] for g in got] == [w[:2] for w in want]
        assert np.allclose([g[2] for g in got], [w[2] for w in want])


def corpus(n=700, seed=2):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        text = words(rng, rng.randint(10, 120)).split(" ")
        bad = rng.random() < 0.2
        if bad:
            for _ in range(max(2, len(text) // 15)):
                text.insert(rng.randrange(len(text)), rng.choice(["Nastyword,", "vileword", "awfulword!"]))
        docs.append((i, " ".join(text)))
        labels.append((i, 1, int(bad)))
    return docs, labels


def test_held_out_accuracy(spark):
    docs, labels = corpus()
    d, lab = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    scored = toxicity.toxic_scores(d, toxicity.fit(d, lab)).join(lab, "doc_id").where(toxicity.is_held_out("doc_id")).collect()
    assert len(scored) > 80
    assert np.mean([r.predicted == r.toxic for r in scored]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in scored)
    assert any(r.segments for r in scored if r.toxic)


def test_odd_rows(spark):
    docs, labels = corpus(200)
    lab = spark.createDataFrame([*labels, (None, 1, 1), (3, None, None), (5, 1, 0)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(spark.createDataFrame(docs, "doc_id long, text string"), lab)
    out = toxicity.toxic_scores(documents(spark), model)
    assert out.count() == len(rows()) and out.where("score is null or predicted is null").count() == 0
    assert toxicity.toxic_scores(empty(spark), model).count() == 0
    none = toxicity.fit(empty(spark), lab)
    assert toxicity.toxic_scores(documents(spark), none).where("predicted = 1").count() == 0
    clean = toxicity.keep_clean(documents(spark), lab)
    assert clean.columns == documents(spark).columns


def test_scores_equal_slow_scorer(spark):
    """Each score from the words' weights alone: segments by their definition, one document after the other."""
    docs, labels = corpus(120, seed=5)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    model = toxicity.fit(d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    w, mean, scale = model.fit
    got = {r.doc_id: r for r in toxicity.toxic_scores(d, model).collect()}
    for i, text in docs[:25]:
        x = [float(model.weight[toxicity.tokens(pa.array([word]))[0][0]]) for word in text.split()][:45]
        short = toxicity.toxic_scores(spark.createDataFrame([(1, " ".join(text.split()[:45]))], "doc_id long, text string"), model).first()
        found = sorted((s for _, _, s in brute_segments(x)), reverse=True)
        n = max(1, len(x))
        features = (-math.log(n), 0.0, 0.0)
        if found:
            over = [model.root * s - math.log(n) for s in found]
            features = (over[0], math.log1p(sum(o for o in over if o > 0)), math.log1p(1000 * sum(found) / n))
        z = sum(a * (f - m) / s for a, f, m, s in zip(w, features, mean, scale)) + w[-1]
        assert math.isclose(short.score, 1 / (1 + math.exp(-max(-30, min(30, z)))), rel_tol=1e-5, abs_tol=1e-9)
        assert got[i].predicted == (got[i].score >= 0.5)


def test_columns_keep_their_names(spark):
    docs, labels = corpus(120)
    names = ["_text", "_got", "_id", "_toxic", "_row", "score", "segments"]
    d = spark.createDataFrame([(i, t, *names) for i, t in docs], ["doc_id", "text", *names])
    out = toxicity.keep_clean(d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert out.columns == d.columns and all([r[n] for n in names] == names for r in out.collect())
