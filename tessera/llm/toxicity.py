"""Toxicity by maximum-scoring segments of token log-odds."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.scratch import free, small_batches
from tessera.llm.words import TABLE, slices, spans_of, word_hashes

#: Labelled documents that the fit uses at most (expected; drawn by hash), and buckets of the word table.
FIT_ROWS, BUCKETS = 60_000, 1 << 19
#: Dirichlet prior mass, standard errors a log-odds is drawn towards zero by, and the charge of a token.
PRIOR, SHRINK, DRIFT = 1000.0, 2.0, 0.02
#: Bytes of a word that count: all but ASCII's signs.
_PLAIN = np.array([b > 127 or chr(b).isalnum() or chr(b).isspace() for b in range(256)])
_NUMBERS = np.where(_PLAIN[:, None], TABLE.reshape(256, 64), np.uint64(0)).ravel()


def tokens(texts: pa.Array) -> list[np.ndarray]:
    """The buckets of each text's words, without A-Z's case and ASCII's signs."""
    words = spans_of(texts)
    numbers, _ = word_hashes(words.data, words.starts, len(words.data), _NUMBERS, _PLAIN)
    return np.split((numbers & np.uint64(BUCKETS - 1)).astype(np.int64), np.searchsorted(words.text, np.arange(1, len(texts))))


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments ``(first, past, score)`` in linear time (Ruzzo and Tompa).

    Runs without a positive score are only summed, so the loop visits positive scores alone.
    """
    at = np.flatnonzero(scores > 0)
    if not len(at):
        return []
    total = np.cumsum(scores)
    right = total[at]
    left = (right - scores[at]).tolist()
    right = right.tolist()
    stack: list[tuple[float, float, int, int]] = []
    for i, low, high in zip(at.tolist(), left, right, strict=True):
        first = i
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][0] >= low:
                j -= 1
            if j < 0 or stack[j][1] >= high:
                stack.append((low, high, first, i + 1))
                break
            low, first = stack[j][0], stack[j][2]
            del stack[j:]
    return [(first, past, high - low) for low, high, first, past in stack]


def log_odds(toxic: np.ndarray, clean: np.ndarray, drift: float = DRIFT) -> np.ndarray:
    """Log-odds ratio of each bucket with a Dirichlet prior of the pooled frequencies, drawn towards zero by its own
    standard error, less what every token costs."""
    both = toxic + clean
    a, b = toxic.sum(), clean.sum()
    if not a or not b:
        return np.full(len(toxic), -drift)
    prior = PRIOR * both / both.sum() + 1e-3
    whole = prior.sum()
    delta = np.log((toxic + prior) / (a + whole - toxic - prior)) - np.log((clean + prior) / (b + whole - clean - prior))
    error = np.sqrt(1 / (toxic + prior) + 1 / (clean + prior))
    return np.sign(delta) * np.maximum(np.abs(delta) - SHRINK * error, 0) - drift


def decay(scores: np.ndarray, share: np.ndarray) -> float:
    """The positive root of sum(share exp(root score)) = 1: how fast chance segments get rarer with their score."""
    if not (scores[share > 0] > 0).any() or scores @ share >= 0:
        return 1.0
    low, high = 0.0, 1.0
    grow = lambda x: float(share @ np.exp(np.minimum(x * scores, 60.0)))
    while grow(high) < 1 and high < 64:
        low, high = high, high * 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if grow(middle) < 1 else (low, middle)
    return high


def _features(ids: np.ndarray, weight: np.ndarray, root: float) -> tuple[float, float, float]:
    """Of a document's segments: the best one's score against chance in a text this long, the sum of all that are
    beyond chance, and that by length."""
    n = max(1, len(ids))
    found = sorted((s[2] for s in segments(weight[ids])), reverse=True) if len(ids) else []
    if not found:
        return -math.log(n), 0.0, 0.0
    best = root * found[0] - math.log(n)
    many = sum(x for s in found if (x := root * s - math.log(n)) > 0)
    return best, math.log1p(many), math.log1p(1000 * sum(found) / n)


def _count():
    schema = pa.schema([("bucket", pa.int64()), ("toxic", pa.int64()), ("clean", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, BUCKETS), np.int64)
        for batch in slices(batches, 0):
            for ids, label in zip(tokens(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                # A word counts once per document: long documents don't outvote the others.
                seen[0 if label else 1, np.unique(ids)] += 1
        at = np.flatnonzero(seen.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[0, at]), pa.array(seen[1, at])], schema=schema)

    return run


def _measure(weight: np.ndarray, root: float):
    schema = pa.schema([("label", pa.int64()), *[(c, pa.float64()) for c in "xyz"]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0):
            got = [_features(ids, weight, root) for ids in tokens(batch.column(0))]
            yield pa.RecordBatch.from_arrays([batch.column(1), *[pa.array(c, pa.float64()) for c in zip(*got, strict=True)]], schema=schema)

    return run


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights (the constant last) by Newton's method on standardised columns, with their means and scales."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    a = np.c_[(x - mean) / scale, np.ones(len(x))]
    w = np.zeros(a.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + ridge * len(x) * np.eye(len(w)) / 100 + 1e-9 * np.eye(len(w)), a.T @ (y - p) - ridge * len(x) / 100 * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w, mean, scale


class Model:
    """Word weights, the extreme-value scale, and the fit that turns segment scores into a probability."""

    def __init__(self, weight, root, fit):
        self.weight, self.root, self.fit = weight, root, fit

    def score(self, ids: np.ndarray) -> tuple[float, list[tuple[int, int, float]]]:
        w, mean, scale = self.fit
        x = (np.array(_features(ids, self.weight, self.root)) - mean) / scale
        return 1 / (1 + math.exp(-min(30.0, max(-30.0, float(x @ w[:-1] + w[-1])))))


def is_held_out(doc_id) -> F.Column:
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(5)) == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    """Learn from labelled documents that aren't held out: about ``rows`` of them, drawn by hash where there are more.

    Word counts, a table of at most BUCKETS rows, and three numbers for each fitted document reach the driver.
    """
    label = labels.where("toxic is not null and doc_id is not null").where(~is_held_out("doc_id"))
    label = label.groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.max("toxic").cast("long").alias("_toxic"))
    n = label.count()
    if n > rows:
        label = label.where(F.pmod(F.xxhash64("_id", F.lit(6)), F.lit(1_000_000)) < int(1_000_000 * rows / n))
    # Bounded by ``rows`` pairs of integers.
    some = docs.select("doc_id", "text").join(F.broadcast(label), F.col("doc_id").cast("long") == F.col("_id")).select("text", "_toxic")
    toxic, clean = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for bucket, a, b in some.mapInArrow(_count(), "bucket long, toxic long, clean long").groupBy("bucket").agg(F.sum("toxic"), F.sum("clean")).where("sum(toxic) + sum(clean) > 2").toPandas().itertuples(index=False):
        toxic[bucket], clean[bucket] = a, b
    weight = log_odds(toxic, clean).astype(np.float32)
    share = clean / max(1.0, clean.sum())
    root = decay(weight.astype(float), share)
    got = some.mapInArrow(_measure(weight, root), "label long, x double, y double, z double").toPandas()
    if len(got) and got["label"].nunique() == 2:
        return Model(weight, root, logistic(got[["x", "y", "z"]].to_numpy(), got["label"].to_numpy(float)))
    constant = 30.0 if len(got) and got["label"].max() else -30.0
    return Model(weight, root, (np.array([0, 0, 0, constant]), np.zeros(3), np.ones(3)))


def toxic_scores(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` (0 to 1), ``predicted`` (1 from 0.5 on) and ``segments``, the significant passages as
    ``(first word, past word, score)``.

    The whole text counts. Null and empty texts get the score of a text without any scored segment. Nothing but the
    text is an input. Columns of ``docs`` with these names give way; no rows give no rows.
    """
    small_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c not in ("score", "predicted", "segments")]
    table = docs.sparkSession.sparkContext.broadcast(model)
    kind = "struct<score: double, segments: array<struct<first: long, past: long, score: double>>>"

    @F.pandas_udf(kind)
    def measure(texts):
        import pandas as pd

        own = table.value
        score, passages = [], []
        batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
        for part in slices(iter([batch]), 0):
            for ids in tokens(part.column(0)):
                score.append(own.score(ids))
                floor = math.log(max(1, len(ids))) / own.root
                passages.append([{"first": a, "past": b, "score": float(s)} for a, b, s in segments(own.weight[ids]) if s > floor] if len(ids) else [])
        return pd.DataFrame({"score": score, "segments": passages})

    got = free(docs, "got")
    out = docs.select(*kept, measure(F.col("text")).alias(got))
    return out.select(*kept, F.col(f"{got}.score").alias("score"), (F.col(f"{got}.score") >= 0.5).cast("int").alias("predicted"), F.col(f"{got}.segments").alias("segments"))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without those that the model predicts to be toxic; same columns, whatever their names.

    Null and empty texts, null and repeated ids are scored like any others. No rows, no rows.
    """
    row = free(docs, "row")
    packed = docs.select(F.struct(*docs.columns).alias(row), F.col("text"))
    return toxic_scores(packed, fit(docs, labels)).where("predicted = 0").select(*[F.col(row)[c].alias(c) for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxic_scores(docs.select("doc_id", "text"), fit(docs, labels))
    return scored.select("doc_id", is_held_out("doc_id").alias("held_out"), "score", "predicted", F.size("segments").alias("n_segments"))
