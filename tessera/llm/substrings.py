"""Exact substring deduplication by suffix arrays."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.scratch import Scratch, is_empty, small
from tessera.llm.suffixes import common_prefixes, suffix_array
from tessera.llm.words import mix, slices, texts_of

#: Bytes of a repeated string; of an anchor; of a shard's texts (about); texts of one anchor in a shard (about); windows
#: of a run at most; windows that are merged in one task (about).
LENGTH, ANCHOR, SHARD, TOGETHER, LONGEST, MERGED = 400, 64, 1 << 19, 1024, 1 << 15, 1 << 17
_MULTIPLIERS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_PLACE = 20


def window_hashes(text: np.ndarray, width: int, multiplier: np.uint64) -> np.ndarray:
    """64-bit hash of each run of ``width`` bytes, built from runs of powers of two."""
    own = mix(text.astype(np.uint64) + multiplier)
    out, done, power = None, 0, multiplier
    step = 1
    while step <= width:
        if width & step:
            if out is None:
                out, done = own, step
            else:
                n = len(text) - done - step + 1
                out = out[:n] * power + own[done : done + n]
                done += step
        own = own[: len(own) - step] * power + own[step:] if len(own) > step else own[:0]
        with np.errstate(over="ignore"):
            power = power * power
        step *= 2
    return mix(out)


def _least(text: np.ndarray, length: int, anchor: int, turn: int) -> tuple[np.ndarray, np.ndarray]:
    """Smallest hash, and its place, of the anchors in each run of ``length`` bytes of a text of under a million."""
    mask = np.uint64((1 << _PLACE) - 1)
    own = window_hashes(text, anchor, _MULTIPLIERS[turn])
    low = (own & ~mask) | np.arange(len(own), dtype=np.uint64)
    width, done = length - anchor + 1, 1
    while done * 2 <= width:
        low = np.minimum(low[:-done], low[done:])
        done *= 2
    if done < width:
        low = np.minimum(low[: len(low) - (width - done)], low[width - done :])
    place = (low & mask).astype(np.int64)
    return own[place], place


def _split(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last places of runs of equal keys, of LONGEST at most."""
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    last = np.append(first[1:], len(key)) - 1
    if (last - first >= LONGEST).any():
        parts = (last - first) // LONGEST + 1
        spot = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        first = np.repeat(first, parts) + spot * LONGEST
        last = np.minimum(first + LONGEST - 1, np.repeat(last, parts))
    return first, last


def anchors(text: np.ndarray, length: int = LENGTH, anchor: int = ANCHOR) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(hash, first, last, places)``: runs of up to LONGEST windows of ``length`` bytes that have one smallest anchor hash.

    Equal windows choose the same anchor in them, so two can only be equal if their anchors are; each window is in
    exactly one run. Windows over a repeated byte or word have one smallest hash at ever new places: they are one run,
    of 2 ``places``, which may repeat itself; other runs have 1.
    """
    n = len(text)
    if n < length:
        return np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3
    out: list = [[], [], [], []]
    span = 1 << (_PLACE - 1)
    for at in range(0, n - length + 1, span):
        least, place = _least(text[at : at + span + length - 1], length, anchor, 0)
        first, last = _split(least)
        for column, x in zip(out, (least[first], first + at, last + at, 1 + (place[first] != place[last])), strict=True):
            column.append(x)
    return tuple(np.concatenate(x) for x in out)  # type: ignore[return-value]


def half_anchors(text: np.ndarray, length: int = LENGTH, anchor: int = ANCHOR) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """As ``anchors``, of a text of one run, by two anchors in each window, one in either half, chosen by another hash."""
    half = length // 2
    least, place = _least(text, half, min(anchor, half), 1)
    n, back = len(text) - length + 1, length - half
    key = mix(least[:n] ^ mix(least[back : back + n]))
    first, last = _split(key)
    moved = (place[first] != place[last]) | (place[first + back] != place[last + back])
    return key[first], first, last, 1 + moved


def _name(text: bytes) -> tuple[int, int]:
    a, b = np.frombuffer(hashlib.blake2b(text, digest_size=16).digest(), "<i8")
    return int(a), int(b)


def _find(length: int, with_text: bool):
    fields = [("doc_id", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("n_bytes", pa.int64()), ("sha", pa.string()),
                        ("runs", pa.list_(pa.struct([("anchor", pa.int64()), ("first", pa.int32()), ("last", pa.int32()), ("places", pa.int32())])))]
    schema = pa.schema([*fields, ("whole", pa.binary())] if with_text else fields)

    def run(batches):
        for batch in slices(batches, 1, 256):
            if batch.num_rows:
                texts = texts_of(batch.column(1))
                names, sizes, shas, got = [], [], [], []
                for text in texts:
                    names.append(_name(text))
                    sizes.append(len(text))
                    shas.append(hashlib.sha256(text).hexdigest())
                    got.append(anchors(np.frombuffer(text, np.uint8), length))
                flat = [np.concatenate(x) for x in zip(*got, strict=True)]
                runs = pa.StructArray.from_arrays([pa.array(flat[0].view(np.int64)), pa.array(flat[1], pa.int32()), *[pa.array(x, pa.int32()) for x in flat[2:]]], ["anchor", "first", "last", "places"])
                offsets = pa.array(np.concatenate([[0], np.cumsum([len(g[0]) for g in got])]), pa.int32())
                one, two = zip(*names, strict=True)
                columns = [batch.column(0), pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array(sizes, pa.int64()), pa.array(shas), pa.ListArray.from_arrays(offsets, runs)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.binary())] if with_text else columns, schema=schema)

    return run, "doc_id long, h1 long, h2 long, n_bytes long, sha string, runs array<struct<anchor: long, first: int, last: int, places: int>>" + ", whole binary" * with_text


def _refine(length: int, together: int):
    """The runs whose anchor more than ``together`` texts have, parted by two more anchors in each window."""
    schema = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("anchor", pa.int64()), ("first", pa.int32()), ("last", pa.int32()), ("places", pa.int32())])

    def run(batches):
        for batch in slices(batches, 0, 64):
            out = [[] for _ in schema]
            for text, h1, h2, runs in zip(texts_of(batch.column(0)), *[batch.column(k).to_pylist() for k in (1, 2, 3)], strict=True):
                for r in runs:
                    if r["n"] > together:
                        own, first, last, places = half_anchors(np.frombuffer(text, np.uint8)[r["first"] : r["last"] + length], length)
                        key = mix(own ^ mix(np.array([r["anchor"]], np.int64).view(np.uint64)))
                        for column, x in zip(out, (np.full(len(key), h1), np.full(len(key), h2), key.view(np.int64), first + r["first"], last + r["first"], places), strict=True):
                            column.append(x)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), t) for c, t in zip(out, schema.types, strict=True)], schema=schema)

    return run, "h1 long, h2 long, anchor long, first int, last int, places int"


def _texts(length: int, shards: int, together: int):
    """The text of each run, with all bytes of its windows, and the shard it goes to. Equal texts go to one shard;
    others of an anchor with more than ``together`` go to several."""
    schema = pa.schema([("shard", pa.int64()), ("hot", pa.bool_()), ("h1", pa.int64()), ("h2", pa.int64()), ("first", pa.int32()), ("part", pa.binary())])

    def run(batches):
        for batch in slices(batches, 0, 64):
            rows = []
            for text, h1, h2, runs in zip(texts_of(batch.column(0)), *[batch.column(k).to_pylist() for k in (1, 2, 3)], strict=True):
                for r in runs:
                    part = text[r["first"] : r["last"] + length]
                    several = -(-r["n"] // together)
                    spot = xxhash.xxh3_64_intdigest(part) % several
                    shard = xxhash.xxh3_64_intdigest(b"%d %d" % (r["anchor"], spot)) % shards
                    rows.append((shard, several > 1, h1, h2, r["first"], part))
            for at in range(0, len(rows), 4096):
                some = rows[at : at + 4096]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some, strict=True), schema.types, strict=True)], schema=schema)

    return run, "shard long, hot boolean, h1 long, h2 long, first int, part binary"


_FOUND = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("first", pa.int64()), ("past", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64())])


def _runs_of(flag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.concatenate([[False], flag, [False]]).astype(np.int8)))
    return edge[::2], edge[1::2]


def _shard(length: int):
    """Repeated windows within a shard; of texts whose anchor other shards hold too, the windows to look up there.

    Equal texts of a shard are sorted as one: each of their windows is found in all of them.
    """

    def work(table: pa.Table) -> pa.Table:
        coded = table.column("part").combine_chunks().cast(pa.large_binary()).dictionary_encode()
        parts, of = coded.dictionary, coded.indices.to_numpy()
        held = np.bincount(of, minlength=len(parts))
        offsets = np.frombuffer(parts.buffers()[1], np.int64)[parts.offset : parts.offset + len(parts) + 1]
        text = np.frombuffer(parts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
        starts, ends_of = offsets[:-1] - offsets[0], offsets[1:] - offsets[0]
        sizes = ends_of - starts
        stops = ends_of - length + 1
        ends = np.repeat(ends_of, sizes)
        order, rank = suffix_array(text, ends, length)
        shared = common_prefixes(text, ends, starts, stops, order, rank, length)
        # Windows in the order of their suffixes; a shared prefix of the whole length joins one to the one before.
        whole = order[shared[order] >= 0]
        joined = shared[whole] >= length
        twice = joined.copy()
        twice[:-1] |= joined[1:]
        run = np.repeat(np.arange(len(sizes)), sizes)
        twice |= held[run[whole]] > 1
        flag = np.zeros(len(text) + 1, bool)
        flag[whole[twice]] = True
        h1, h2, first = (table.column(c).to_numpy() for c in ("h1", "h2", "first"))
        out = [[], [], [], [], [], []]
        a, b = _runs_of(flag[:-1])
        if len(a):
            # A run's last window is followed by bytes that start none, so no stretch spans two texts. Each stretch is
            # in every row that has its text.
            r = run[a]
            own = np.bincount(r, minlength=len(sizes))
            row = np.repeat(np.arange(len(of)), own[of])
            base = np.cumsum(own) - own
            k = np.arange(len(row)) - np.repeat(np.cumsum(own[of]) - own[of], own[of]) + base[of[row]]
            low, high = first[row] + a[k] - starts[r[k]], first[row] + b[k] - starts[r[k]] - 1 + length
            for column, value in zip(out, (h1[row], h2[row], low, high, np.zeros(len(row), np.int64), np.zeros(len(row), np.int64)), strict=True):
                column.append(value)
        hot = table.column("hot").to_numpy(zero_copy_only=False)
        if hot.any():
            # A row of each text; where there are several, their windows are known, and one is witness.
            some = np.zeros(len(sizes), np.int64)
            some[of] = np.arange(len(of))
            f = [window_hashes(text, length, m).view(np.int64) for m in _MULTIPLIERS]
            heads = whole[~joined & hot[some[run[whole]]]]
            # Windows of one text each, with their place; of those found twice here one witness, without a place.
            known = flag[heads]
            r = some[run[heads]]
            at = np.where(known, -1, first[r] + heads - starts[run[heads]])
            for column, value in zip(out, (h1[r], h2[r], at, np.full(len(at), -1), f[0][heads], f[1][heads]), strict=True):
                column.append(value)
        return pa.table([pa.array(np.concatenate(c) if c else np.zeros(0, np.int64), pa.int64()) for c in out], schema=_FOUND)

    return work, "h1 long, h2 long, first long, past long, f1 long, f2 long"


def _merge(length: int):
    """Windows with a place that another shard holds as well, found by binary search in the merged order."""
    schema = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("first", pa.int64()), ("past", pa.int64())])

    def work(table: pa.Table) -> pa.Table:
        f = np.stack([table.column(c).to_numpy() for c in ("f1", "f2")], 1).astype(">i8")
        # Bytes compare as text, where a zero at the end counts for nothing: one more byte keeps each name whole.
        names = np.frombuffer(np.concatenate([f.view(np.uint8).reshape(-1, 16), np.ones((len(f), 1), np.uint8)], 1).tobytes(), "S17")
        merged = np.sort(names)
        count = np.searchsorted(merged, names, "right") - np.searchsorted(merged, names, "left")
        at = table.column("first").to_numpy()
        good = (count > 1) & (at >= 0)
        return pa.table([pa.array(table.column("h1").to_numpy()[good]), pa.array(table.column("h2").to_numpy()[good]), pa.array(at[good]), pa.array(at[good] + length)], schema=schema)

    return work, "h1 long, h2 long, first long, past long"


def _cut(with_text: bool):
    fields = [("h1", pa.int64()), ("h2", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(pa.struct([("first", pa.int64()), ("past", pa.int64())]))), ("kept_sha256", pa.string()), ("kept", pa.binary())]
    schema = pa.schema(fields if with_text else fields[:-1])

    def run(batches):
        for batch in slices(batches, 0, 64):
            if batch.num_rows:
                rows = []
                for text, h1, h2, firsts, pasts in zip(texts_of(batch.column(0)), *[batch.column(k).to_pylist() for k in (1, 2, 3, 4)], strict=True):
                    change = np.zeros(len(text) + 1, np.int64)
                    np.add.at(change, firsts, 1)
                    np.add.at(change, pasts, -1)
                    gone = np.cumsum(change)[:-1] > 0
                    a, b = _runs_of(gone)
                    left = np.frombuffer(text, np.uint8)[~gone].tobytes()
                    row = (h1, h2, int(gone.sum()), [{"first": int(x), "past": int(y)} for x, y in zip(a, b, strict=True)], hashlib.sha256(left).hexdigest())
                    rows.append((*row, left) if with_text else row)
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    return run, "h1 long, h2 long, n_removed long, spans array<struct<first: long, past: long>>, kept_sha256 string" + ", kept binary" * with_text


def dedup_substrings(docs: DataFrame, length: int = LENGTH, with_text: bool = False) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans)`` for each row, and ``kept``, the bytes that remain,
    if ``with_text``.

    Removed is each byte covered by a string of ``length`` bytes that also starts anywhere else in the input, in the
    same text or another one. Texts are UTF-8 bytes; null is empty. ``spans`` are the maximal removed runs.

    Equal texts are first counted as one: all of a text that two rows have is removed. Each window of ``length``
    bytes picks the anchor (a 64-byte string) with the smallest hash in it, so equal windows pick equal anchors; texts
    around anchors that occur once are settled. The others are dealt by anchor to shards. A shard sorts the
    suffixes of its texts (Larsson and Sadakane), takes common prefixes (Kasai), and so has all its repeated windows.
    An anchor with more texts than a shard takes is first parted by an anchor in either half of a window, chosen by
    another hash; where that has too many texts still it is dealt to several shards, and windows that those find once each, and
    one witness for each they find twice, are merged by binary search on 128-bit names.

    Results depend on a row's text alone: repeated rows, null and repeated ids need no rule. No rows, no result;
    other columns are ignored.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "substrings")
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    run, schema = _find(length, with_text)
    found = scratch.keep(source.mapInArrow(run, schema))
    # One row per text: its count and a document that has it.
    text = found.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("doc_id").alias("rep"), F.count_if(F.col("doc_id").isNull()).alias("nulls"))
    text = scratch.keep(text)
    one = found.join(text.select("h1", "h2", F.when(F.col("nulls") < F.col("n"), F.col("rep")).alias("rep")), ["h1", "h2"])
    one = one.where(F.col("doc_id").eqNullSafe(F.col("rep"))).select("h1", "h2", "rep", F.explode("runs").alias("r")).select("h1", "h2", "rep", "r.*")
    # Rows that repeat both id and text are one text still.
    again = found.groupBy("h1", "h2", "doc_id").count().where("count > 1")
    if again.limit(1).count():
        one = one.dropDuplicates(["h1", "h2", "first"])
    common = scratch.keep(one.groupBy("anchor").agg(F.sum("places").alias("n")).where("n > 1"))
    cand = scratch.keep(one.join(small(common, F.lit(2)), "anchor"))
    per_text = cand.groupBy("h1", "h2", "rep").agg(F.collect_list(F.struct("anchor", "n", "first", "last")).alias("runs"))
    own = source.join(per_text, F.col("doc_id").eqNullSafe(F.col("rep")))
    name = F.udf(lambda t: _name((t or "").encode()), "struct<a: long, b: long>")
    if again_ids(source):
        own = own.withColumn("_n", name("text")).where("_n.a = h1 and _n.b = h2").dropDuplicates(["h1", "h2"])
    own = scratch.keep(own.select("text", "h1", "h2", "runs"))
    if not is_empty(common.where(F.col("n") > TOGETHER)):
        # Windows of a common passage and what stands beside it differ in the anchor of one half.
        run, schema = _refine(length, TOGETHER)
        parts = scratch.keep(own.where(F.exists("runs", lambda r: r["n"] > TOGETHER)).mapInArrow(run, schema))
        common = scratch.keep(parts.groupBy("anchor").agg(F.sum("places").alias("n")).where("n > 1"))
        parts = parts.join(small(common, F.lit(2)), "anchor").groupBy("h1", "h2").agg(F.collect_list(F.struct("anchor", "n", "first", "last")).alias("more"))
        parts = scratch.keep(parts)
        runs = F.filter("runs", lambda r: r["n"] <= TOGETHER)
        own = own.join(small(parts, 4 * F.size("more")), ["h1", "h2"], "left").select("text", "h1", "h2", F.when(F.col("more").isNull(), runs).otherwise(F.concat(runs, "more")).alias("runs"))
    volume = own.select(F.aggregate("runs", F.lit(0).cast("long"), lambda n, r: n + r["last"] - r["first"] + length).alias("n")).agg(F.sum("n")).first()[0] or 0
    run, schema = _texts(length, max(1, -(-volume // SHARD)), TOGETHER)
    work, found_schema = _shard(length)
    hits = scratch.keep(own.mapInArrow(run, schema).groupBy("shard").applyInArrow(work, found_schema))
    merge, merged_schema = _merge(length)
    late = hits.where("past < 0")
    buckets = -(-late.count() // MERGED) + 1
    late = late.groupBy(F.pmod(F.xxhash64("f1", "f2"), F.lit(buckets))).applyInArrow(merge, merged_schema)
    spans = hits.where("past >= 0").select("h1", "h2", "first", "past").unionByName(late)
    spans = spans.groupBy("h1", "h2").agg(F.collect_list("first").alias("firsts"), F.collect_list("past").alias("pasts"))
    run, schema = _cut(with_text)
    done = own.select("text", "h1", "h2").join(spans, ["h1", "h2"]).select("text", "h1", "h2", "firsts", "pasts").mapInArrow(run, schema)
    out = found.drop("runs").join(text.select("h1", "h2", "n"), ["h1", "h2"]).join(done, ["h1", "h2"], "left")
    copy = (F.col("n") > 1) & (F.col("n_bytes") >= length)
    nothing = F.array().cast("array<struct<first: long, past: long>>")
    every = F.array(F.struct(F.lit(0).cast("long").alias("first"), F.col("n_bytes").alias("past")))
    spans = F.when(copy, every).otherwise(F.coalesce("spans", nothing))
    out = out.select(
        "doc_id",
        "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.size(spans).cast("long").alias("n_spans"),
        F.when(copy, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        spans.alias("spans"),
        *([F.when(copy, F.lit("").cast("binary")).otherwise(F.coalesce("kept", "whole")).alias("kept")] if with_text else []),
    )
    return out


def again_ids(source: DataFrame) -> bool:
    """Whether an id, or no id, is on several rows."""
    return bool(source.groupBy("doc_id").count().where("count > 1").limit(1).count())


def query(spark, sf_dir: str) -> DataFrame:
    return dedup_substrings(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
