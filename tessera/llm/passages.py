"""Substring deduplication by MinHash banding of paragraphs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.scratch import Scratch, free, small
from tessera.llm.units import UNIT, by_documents, removals, sequence_hashes
from tessera.llm.words import Words, mix, shingles, slices, words_of

#: Words of a shingle; similarity of linked paragraphs; fewest words of one, and of two pieces; words to either side that
#: a cut inside a long paragraph has a smaller hash than; longest paragraph that is never cut.
WIDTH, SIMILAR, MIN_WORDS, REACH, WHOLE = 5, 0.8, 8, 4, 24
RECALL, ROWS = 0.99, 3


def tune(similar: float = SIMILAR, recall: float = RECALL, most: int = 64, rows: int = ROWS) -> tuple[int, int]:
    """``(bands, rows)``: the fewest bands of ``rows`` hashes that find a pair of this similarity with this probability."""
    for bands in range(1, most + 1):
        if 1 - (1 - similar**rows) ** bands >= recall:
            return bands, rows
    raise ValueError(f"{most} bands of {rows} don't reach a recall of {recall}")


def cuts(numbers: np.ndarray, line: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """First positions of the pieces of some texts, given their words' hashes and the line and text each is in.

    A line of up to WHOLE words is a piece. A longer one is cut before each word whose pair with the word before it
    has a smaller hash than all pairs within REACH words of its text, so a passage is cut alike wherever it stands.
    """
    n = len(numbers)
    if not n:
        return np.zeros(0, np.int64)
    top = np.iinfo(np.uint64).max
    new = np.ones(n, bool)
    new[1:] = line[1:] != line[:-1]
    pair = np.full(n, top, np.uint64)
    pair[1:] = mix(numbers[1:] + (numbers[:-1] << np.uint64(1)))
    pair[1:][doc[1:] != doc[:-1]] = top
    # Texts are set apart by REACH places that are never smaller.
    spot = np.arange(n) + REACH * (doc - doc[0] + 1)
    wide = np.full(int(spot[-1]) + REACH + 1, top, np.uint64)
    wide[spot] = pair
    low = ~new
    for k in range(1, REACH + 1):
        low &= (pair < wide[spot - k]) & (pair < wide[spot + k])
    low &= (np.bincount(line) > WHOLE)[line]
    return np.flatnonzero(new | low)


def _parts(column: pa.Array) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    """The words of some texts, first words of pieces, and the text and the line that each of these is in."""
    words = words_of(column)
    starts = cuts(words.numbers, words.line, words.text)
    return words, starts, words.text[starts], words.line[starts]


def distinct(run: np.ndarray, spots: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of distinct shingles of each line, which has those from ``spots`` on, ``last`` of them; and a sketch of
    them in two numbers: of each of 128 classes of shingles, whether the line has an odd number."""
    of = np.repeat(np.arange(len(spots)), last)
    value = run[np.repeat(spots - (np.cumsum(last) - last), last) + np.arange(last.sum())]
    own = mix(value + of.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    inorder = np.sort(own)
    again = inorder[1:][inorder[1:] == inorder[:-1]]
    if len(again):
        # The first of each goes on; the others are left out.
        some = np.flatnonzero(again[np.minimum(np.searchsorted(again, own), len(again) - 1)] == own)
        _, first = np.unique(own[some], return_index=True)
        keep = np.ones(len(own), bool)
        keep[some] = False
        keep[some[first]] = True
        of, value = of[keep], value[keep]
    odd = np.bincount(of * 128 + (value & np.uint64(127)).astype(np.int64), minlength=128 * len(spots)) & 1
    return np.bincount(of, minlength=len(spots)).astype(np.int32), np.packbits(odd.astype(np.uint8).reshape(-1, 128), axis=1).view(np.int64)


def _lines(batch: pa.RecordBatch, bands: int, rows: int):
    """Lines of MIN_WORDS words or more: the places of their first piece and past their last, hashes, MinHash bands."""
    ids = batch.column(0).to_numpy(zero_copy_only=False)
    words, starts, doc, line = _parts(batch.column(1))
    numbers = words.numbers
    place = np.arange(len(starts)) - np.searchsorted(doc, doc)
    head = np.flatnonzero(np.searchsorted(line, line) == np.arange(len(starts)))
    past = place[head] + np.diff(np.append(head, len(starts)))
    starts, doc, place = starts[head], doc[head], place[head]
    sizes = np.diff(np.append(starts, len(numbers)))
    good = sizes >= MIN_WORDS
    if not good.any():
        return (None,)
    h1, h2 = sequence_hashes(numbers, starts)
    run = shingles(numbers, WIDTH)
    # A line's shingles start in it and end in it.
    spots, last = starts[good], sizes[good] - WIDTH + 1
    bounds = np.stack([spots, spots + last], 1).ravel()
    keys = np.empty((len(spots), bands), np.uint64)
    value = np.full(len(run) + 1, np.iinfo(np.uint64).max, np.uint64)
    for b in range(bands):
        key = np.full(len(spots), b + 1, np.uint64)
        for r in range(rows):
            value[:-1] = mix(run ^ mix(np.array([b * rows + r + 1], np.uint64)))
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + np.minimum.reduceat(value, bounds)[::2])
        keys[:, b] = key
    lists = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, bands, dtype=np.int32)), pa.array(keys.ravel().view(np.int64)))
    n, odd = distinct(run, spots, last)
    return ids[doc[good]], place[good].astype(np.int32), h1[good].view(np.int64), h2[good].view(np.int64), n, odd[:, 0].copy(), odd[:, 1].copy(), lists, past[good].astype(np.int32)


def _pairs(batch: pa.RecordBatch):
    """Each two pieces of a line that follow each other and have MIN_WORDS words: their place, hashes, and that of the
    line's first piece."""
    ids = batch.column(0).to_numpy(zero_copy_only=False)
    words, starts, doc, line = _parts(batch.column(1))
    numbers = words.numbers
    place = np.arange(len(starts)) - np.searchsorted(doc, doc)
    head = place[np.searchsorted(line, line)]
    sizes = np.diff(np.append(starts, len(numbers)))
    h1, h2 = sequence_hashes(numbers, starts)
    good = np.flatnonzero((line[1:] == line[:-1]) & (sizes[1:] + sizes[:-1] >= MIN_WORDS))
    if not len(good):
        return (None,)
    h1, h2 = (mix(h[good] * np.uint64(0x9E3779B97F4A7C15) + h[good + 1]) for h in (h1, h2))
    return ids[doc[good]], place[good].astype(np.int32), h1.view(np.int64), h2.view(np.int64), head[good].astype(np.int32)


def _sets(per_doc: DataFrame, source: DataFrame) -> DataFrame:
    schema = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("vals", pa.list_(pa.int64()))])

    def run(batches):
        for batch in slices(batches, 0):
            rows = []
            for k, units in enumerate(batch.column(1).to_pylist()):
                words, starts, _, line = _parts(batch.column(0).slice(k, 1))
                numbers = words.numbers
                ends = np.append(starts, len(numbers))[np.searchsorted(line, line, side="right")]
                rows += [(u["h1"], u["h2"], np.unique(shingles(numbers[starts[u["unit"]] : ends[u["unit"]]], WIDTH)).view(np.int64)) for u in units if u["unit"] < len(starts)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else ([], [], []), schema.types, strict=True)], schema=schema)

    found = source.join(per_doc, "doc_id").select("text", "units").mapInArrow(run, "h1 long, h2 long, vals array<long>")
    return found.groupBy("h1", "h2").agg(F.min("vals").alias("vals")).select(F.struct("h1", "h2").alias("id"), "vals")


def _repeated(pairs: DataFrame, scratch: Scratch) -> DataFrame:
    """``(doc_id, unit)`` of the pieces that are in a pair equal to an earlier one. ``pairs`` is a kept table."""
    several = scratch.keep(pairs.groupBy("h1").agg(F.count("*").alias("n")).where("n > 1").select("h1"))
    some = scratch.keep(pairs.join(small(several), "h1"))
    firsts = scratch.keep(some.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "unit")).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"))
    gone = some.join(small(firsts, F.lit(4)), ["h1", "h2"]).where("doc_id <> first.doc_id or unit <> first.unit")
    return gone.select("doc_id", F.explode(F.array("unit", F.col("unit") + 1)).alias("unit"))


def _without(text: str, gone: list[int]) -> str:
    """``text`` without some of its pieces, from each one's first word to the end of its last."""
    words, starts, _, _ = _parts(pa.array([text]))
    data = text.encode()
    first, past = words.starts[starts], np.append(words.starts[starts[1:]], len(data))
    out, at = [], 0
    for k in gone:
        if k < len(starts):
            a, b = int(first[k]), int(past[k])
            out.append(data[at:a])
            at = a + len(data[a:b].rstrip(b"\t\n\x0b\x0c\r "))
    out.append(data[at:])
    return b"".join(out).decode()


def dedup_passages(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """``docs`` with each paragraph that repeats an earlier one taken out of ``text``; the white space around it stays.
    ``removed array<int>`` has the places of the pieces taken (null: none).

    A paragraph is a line. Lines of 8 words or more with a Jaccard similarity of ``similar`` or more on their 5-word
    shingles are linked; pairs come from bands of MinHashes, tuned so that 99 of 100 such pairs share one, and each
    pair is verified on the whole sets. Of each connected group the occurrence in the smallest doc_id, first place,
    stays. A-Z count as a-z.

    Passages repeat inside long lines too. A line of more than 24 words is cut into pieces at places that its own words
    decide, some 9 words apart, so a passage is cut alike wherever it stands. Of the lines that stay, two pieces in a
    row that have 8 words or more and equal an earlier two go. A repeated passage loses all but the words
    before its first cut and after its last.

    Null and empty texts stay as they are, as do rows with a null doc_id. Rows that repeat a doc_id are taken for
    one document. No rows give no rows.
    """
    scratch = Scratch(docs.sparkSession, "passages")
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    bands, rows = tune(similar)
    unit = [("doc_id", pa.int64()), ("unit", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64())]
    line_schema = pa.schema([*unit, ("n_shingles", pa.int32()), ("b0", pa.int64()), ("b1", pa.int64()), ("keys", pa.list_(pa.int64())), ("past", pa.int32())])
    pair_schema = pa.schema([*unit, ("head", pa.int32())])

    def near(a: str, b: str):
        na, nb = F.col(f"{a}n_shingles"), F.col(f"{b}n_shingles")
        # Shingles that sketches prove to be in one of the two only.
        apart = sum((F.bit_count(F.col(f"{a}{c}").bitwiseXOR(F.col(f"{b}{c}"))) for c in ("b0", "b1")), F.lit(0))
        return (F.least(na, nb) >= F.greatest(na, nb) * (similar - 1e-12)) & ((na + nb - apart) >= (na + nb + apart) * (similar - 1e-12))

    def linked(a: str, b: str):
        both = F.size(F.array_intersect(f"{a}vals", f"{b}vals"))
        return both >= (F.size(f"{a}vals") + F.size(f"{b}vals") - both) * (similar - 1e-12)

    of_lines = Scratch(docs.sparkSession, "passage-lines")
    every = of_lines.keep(source.mapInArrow(by_documents(lambda b: _lines(b, bands, rows), line_schema), UNIT + ", n_shingles int, b0 long, b1 long, keys array<long>, past int"))
    long = scratch.keep(every.where("past > unit + 1").groupBy("doc_id", "unit").agg(F.max("past").alias("past")))
    gone = removals(every.drop("past"), lambda per_doc: _sets(per_doc, source), of_lines, linked=linked, near=near)
    lines = scratch.keep(gone.select("doc_id", F.explode("gone").alias("unit")))
    of_lines._clear()
    scratch.settle()
    # What is in a line that goes is no occurrence of a passage that could stay for others.
    pairs = source.mapInArrow(by_documents(_pairs, pair_schema), UNIT + ", head int")
    left = pairs.join(small(lines, F.lit(2)).withColumnRenamed("unit", "head"), ["doc_id", "head"], "left_anti").drop("head")
    parts = _repeated(scratch.keep(left), scratch)
    past = F.coalesce("past", F.col("unit") + 1)
    lines = lines.join(long, ["doc_id", "unit"], "left").select("doc_id", F.explode(F.sequence("unit", past - 1)).alias("unit"))
    gone = lines.unionByName(parts).groupBy("doc_id").agg(F.sort_array(F.collect_set("unit")).alias("gone"))
    doc, taken = free(docs, "doc"), free(docs, "gone")
    gone = scratch.keep(gone.select(F.col("doc_id").alias(doc), F.col("gone").alias(taken)))
    scratch.only(gone)
    columns = [c for c in docs.columns if c != "removed"]

    @F.pandas_udf("string")
    def without(texts, gone):
        import pandas as pd

        return pd.Series([t if g is None or t is None else _without(t, list(g)) for t, g in zip(texts, gone, strict=True)])

    kept = docs.join(gone, docs["doc_id"].cast("long") == F.col(doc), "left").select(*[docs[c] for c in columns], F.col(taken).alias("removed"))
    # Only texts that lose something go through Python.
    changed = kept.where("removed is not null").withColumn("text", without("text", "removed"))
    if "n_chars" in columns:
        changed = changed.withColumn("n_chars", F.length("text").cast("long"))
    return kept.where("removed is null").unionByName(changed)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = dedup_passages(docs)
    return out.select("doc_id", F.coalesce(F.size("removed"), F.lit(0)).alias("n_removed"), "removed",
                      F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))
