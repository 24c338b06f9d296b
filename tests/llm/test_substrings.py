import hashlib
from collections import Counter

import numpy as np
import pytest

from tessera.llm import substrings
from tessera.llm.suffixes import common_prefixes, suffix_array
from tests.llm.data import documents, empty, rows


def brute(texts, length):
    count = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out.append((len(t), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("together", [256, 2])
def test_equals_brute_force(spark, monkeypatch, together):
    monkeypatch.setattr(substrings, "TOGETHER", together)  # 2: anchors are dealt to several shards and merged
    data = rows()
    got = substrings.dedup_substrings(documents(spark)).collect()
    want = brute([(r[1] or "").encode() for r in data], 400)
    ids = [r[0] for r in data]
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == sorted((str(i), *w) for i, w in zip(ids, want, strict=True))


def test_kept_is_what_its_digest_says(spark):
    data = rows()
    got = substrings.dedup_substrings(documents(spark), with_text=True).collect()
    assert len(got) == len(data)
    for r in got:
        assert r.kept is not None and len(r.kept) == r.n_bytes - r.n_removed
        assert hashlib.sha256(r.kept).hexdigest() == r.kept_sha256
    whole = {r[0]: (r[1] or "").encode() for r in data}
    clean = [r for r in got if not r.n_removed and r.doc_id not in (None, 7)]
    assert clean and all(bytes(r.kept) == whole[r.doc_id] for r in clean)


def test_empty(spark):
    assert substrings.dedup_substrings(empty(spark)).count() == 0


def test_suffix_array_and_prefixes():
    rng = np.random.default_rng(1)
    texts = [bytes(rng.integers(97, 99, rng.integers(1, 60)).astype(np.uint8)) for _ in range(30)] + [b"a" * 90, b"a" * 90]
    flat = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts])
    past = np.cumsum(sizes)
    ends = np.repeat(past, sizes)
    order, rank = suffix_array(flat, ends, 200)
    suffix = [flat[i : ends[i]].tobytes() for i in range(len(flat))]
    assert [suffix[i] for i in order] == sorted(suffix)
    shared = common_prefixes(flat, ends, past - sizes, past, order, rank, 200)
    for a, b in zip(order, order[1:]):
        n = 0
        while n < min(len(suffix[a]), len(suffix[b])) and suffix[a][n] == suffix[b][n]:
            n += 1
        assert shared[b] == n


@pytest.mark.parametrize("longest", [1 << 15, 50])
def test_periodic_texts(spark, monkeypatch, longest):
    """Long texts of one byte or word repeated; with 50, their runs are split."""
    monkeypatch.setattr(substrings, "LONGEST", longest)
    texts = ["x" * 3000, "abc " * 700, "x" * 399, "x" * 400 + "y", "head " + "abc " * 150 + "tail", "z" * 450, "ab" * 200, "", None]
    assert sum(len(substrings.anchors(np.frombuffer(t.encode(), np.uint8))[0]) for t in texts[:2]) <= 6000 // min(longest, 3000) + 6
    got = substrings.dedup_substrings(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got] == brute([(t or "").encode() for t in texts], 400)


def test_long_text(spark):
    """A text of 200,000 bytes with a passage of its own twice, and a copy of part of it."""
    rng = np.random.default_rng(3)
    long = bytes(rng.integers(97, 123, 200_000).astype(np.uint8))
    long = long[:150_000] + long[1000:2000] + long[150_000:]
    texts = [long.decode(), long[70_000:90_000].decode(), long[70_500:71_000].decode()]
    got = substrings.dedup_substrings(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got] == brute([t.encode() for t in texts], 400)


def test_prefixes_of_suffixes_equal_beyond_the_depth():
    """Texts equal for some bytes more than are sorted, in an order that the next position reverses."""
    rng = np.random.default_rng(5)
    for _ in range(60):
        common = bytes(rng.integers(97, 100, int(rng.integers(20, 40))).astype(np.uint8))
        texts = [common + bytes(rng.integers(97, 100, int(rng.integers(0, 20))).astype(np.uint8)) for _ in range(6)]
        flat = np.frombuffer(b"".join(texts), np.uint8)
        sizes = np.array([len(t) for t in texts])
        past = np.cumsum(sizes)
        ends = np.repeat(past, sizes)
        order, rank = suffix_array(flat, ends, 12)
        shared = common_prefixes(flat, ends, past - sizes, past, order, rank, 12)
        for a, b in zip(order, order[1:]):
            n, most = 0, min(ends[a] - a, ends[b] - b, 12)
            while n < most and flat[a + n] == flat[b + n]:
                n += 1
            assert shared[b] == n
