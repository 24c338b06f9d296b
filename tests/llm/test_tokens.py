import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tessera.llm import packing, pieces
from tessera.llm.token_bytes import Packed
from tests.llm.data import documents, empty, rows, texts


@pytest.fixture(scope="module")
def odd():
    rng = random.Random(4)
    more = ["".join(rng.choice(" ab'1.\n\t é_&▁") for _ in range(60)) for _ in range(300)]
    return texts() + more + ["  a   b", "▁a ▁", "<|endoftext|> x", "<s> y", "it's 'quoted' don't", "𝒳 含", "a\x00b"] + [" " * k + "w" for k in range(20)]


def test_byte_ids(odd):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    got = Packed(path).encode(odd)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [tokenizer.encode(t, add_special_tokens=False).ids for t in odd]


def test_pieces_equal_the_library(odd):
    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    encoder = pieces.Encoder(pieces.Pieces(path))
    got = encoder.encode(odd)
    want = model.encode(odd)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == want
    assert [encoder.decode(g) for g in got] == [model.decode(w) for w in want]


def test_piece_columns(spark):
    docs = documents(spark)
    out = pieces.decode(pieces.encode(docs)).select("text", "ids", "decoded").collect()
    assert len(out) == len(rows())
    assert all((r.ids is None and r.decoded is None) if r.text is None else r.decoded == r.text for r in out)
    assert pieces.digests(empty(spark)).count() == 0 and pieces.digests(docs).count() == len(rows())


def test_patterns():
    rng = np.random.default_rng(3)
    for _ in range(5):
        demand = np.where(rng.random(64) < 0.5, rng.integers(0, 200, 64), 0)
        found = packing.patterns(demand)
        size = np.arange(1, 65)
        assert all((count @ size) <= 64 for count, _ in found)
        assert (sum(count * times for count, times in found) >= demand).all()
        bins = []
        for item in np.repeat(size, demand)[::-1]:  # first fit, largest first
            at = next((i for i, room in enumerate(bins) if room >= item), None)
            if at is None:
                bins.append(64 - item)
            else:
                bins[at] -= item
        assert sum(t for _, t in found) <= len(bins) + 1
    assert packing.patterns(np.zeros(8, int)) == []


def test_packing(spark):
    data = rows()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    got = packing.pack(documents(spark)).collect()
    want = []
    for r in data:
        ids = np.array(tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [1], "<u4")
        want += [(str(r[0]), s, min(2048, len(ids) - s), zlib.crc32(ids[s : s + 2048].tobytes()), len(ids)) for s in range(0, len(ids), 2048)]
    assert sorted((str(r.doc_id), r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == sorted(want)
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.pack(empty(spark)).count() == 0


def test_slots_take_no_python_worker(spark):
    """The table of slots is made in the JVM: rows of a Python list would start workers of another kind beside the others."""
    for docs in (documents(spark), empty(spark)):
        slots = [x for x in packing.pack(docs)._jdf.queryExecution().optimizedPlan().toString().split("\n") if "ExistingRDD" in x or "LogicalRDD" in x]
        assert not slots
