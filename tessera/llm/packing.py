"""Packing documents into fixed-length sequences by cutting-stock column generation."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.scratch import Scratch, partitions
from tessera.llm.token_bytes import packed
from tessera.llm.words import give_back

LENGTH, END, GRAIN = 2048, 1, 8
_PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())])
_SLOTS = pa.schema([("size", pa.int32()), ("first", pa.int64()), ("past", pa.int64()), ("each", pa.int64()), ("sequence", pa.int64())])


def _pieces(tokenizer: str, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = packed(tokenizer)
        end = END.to_bytes(4, "little")
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                rows = []
                for doc, ids in zip(batch.column(0).to_pylist(), words.encode([x or "" for x in batch.column(1).to_pylist()]), strict=True):
                    ids = memoryview(ids + end)
                    n = len(ids) // 4
                    rows += [(doc, s, min(length, n - s), zlib.crc32(ids[4 * s : 4 * (s + length)]), n) for s in range(0, n, length)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _PIECES.types, strict=True)], schema=_PIECES)
        give_back()

    return run


def best_pattern(value: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack over sizes 1..capacity: the largest total value, and how many of each size give it."""
    best, took = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for room in range(1, capacity + 1):
        gain = best[room - 1 :: -1][:room] + value[:room]
        k = int(np.argmax(gain))
        if gain[k] > best[room - 1] + 1e-12:
            best[room], took[room] = gain[k], k + 1
        else:
            best[room] = best[room - 1]
    count, room = np.zeros(capacity, np.int64), capacity
    while room > 0:
        if took[room]:
            count[took[room] - 1] += 1
            room -= took[room]
        else:
            room -= 1
    return float(best[capacity]), count


def patterns(demand: np.ndarray, rounds: int = 4000) -> list[tuple[np.ndarray, int]]:
    """``(count of each size, times used)`` covering ``demand[i]`` items of size i + 1 in bins of ``len(demand)``.

    The linear program is solved by the revised simplex method on the patterns known so far; the knapsack program
    prices new ones until none helps, or ``rounds`` are over (some hundreds are usual for 256 sizes); the patterns then
    known cover the demand as well, with more padding. Uses are rounded down, and what that leaves, fewer items than patterns hold
    once each, goes first-fit, largest first.
    """
    capacity = len(demand)
    used = np.flatnonzero(demand)
    if not len(used):
        return []
    basis = np.zeros((capacity, len(used)), np.int64)
    for j, i in enumerate(used):
        basis[i, j] = capacity // (i + 1)
    inverse = np.diag(1.0 / basis[used, np.arange(len(used))])
    need = demand[used].astype(float)
    level = inverse @ need
    for _ in range(rounds):
        value = np.zeros(capacity)
        value[used] = np.maximum(inverse.sum(0), 0)
        worth, count = best_pattern(value, capacity)
        if worth < 1 + 1e-7:
            break
        move = inverse @ count[used]
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(move > 1e-9, level / move, np.inf)
        out = int(np.argmin(ratio))
        if not np.isfinite(ratio[out]):
            break
        pivot = inverse[out] / move[out]
        inverse -= np.outer(move, pivot)
        inverse[out] = pivot
        basis[:, out] = count
        level = np.maximum(inverse @ need, 0)
    found, left = [], demand.astype(np.int64).copy()
    for j in np.argsort(-level, kind="stable"):
        times = int(level[j] + 1e-6)
        if times:
            found.append((basis[:, j].copy(), times))
            left -= basis[:, j] * times
    left = np.maximum(left, 0)
    while left.any():
        count, room = np.zeros(capacity, np.int64), capacity
        for i in range(capacity - 1, -1, -1):
            take = min(left[i], room // (i + 1))
            count[i], room = take, room - take * (i + 1)
        times = max(1, int(np.min(left[count > 0] // count[count > 0])))
        found.append((count, times))
        left -= count * times
    return found


def pack(docs: DataFrame, tokenizer: str | None = None, length: int = LENGTH, grain: int = GRAIN) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    A document is its tokens and id 1. It is cut into pieces of ``length`` and a last shorter one; a piece's size is
    its length in units of ``grain``, rounded up. The histogram of sizes, at most ``length / grain`` numbers, is
    all the driver sees: column generation turns it into patterns with a number of uses. Pieces are ranked within
    their size (by counts per shard, so no size is gathered in a task), and a rank picks the pattern, the sequence
    and the place in it. Sequences hold at most ``length`` tokens, offsets have no gaps, the rest is padding.

    Null and empty texts are id 1 alone; a null doc_id stays null; each row of repeated rows is packed; no rows give
    no rows. Strings of special tokens in a text are ordinary text. Other columns are ignored.
    """
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    spark = docs.sparkSession
    scratch = Scratch(spark, "pack")
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    piece = scratch.keep(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_pieces(tokenizer, length), schema))
    shards = 4 * partitions(spark)
    piece = piece.withColumn("size", F.ceil(F.col("length") / grain).cast("int"))
    piece = piece.withColumn("shard", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(shards)).cast("int"))
    counts = scratch.keep(piece.groupBy("size", "shard").agg(F.count("*").alias("n")))
    demand = np.zeros(length // grain, np.int64)
    for size, n in counts.groupBy("size").agg(F.sum("n")).collect():
        demand[size - 1] = n
    slots, sequence, seen = [], 0, np.zeros(len(demand), np.int64)
    for count, times in patterns(demand):
        for i in np.flatnonzero(count):
            first = int(seen[i])
            seen[i] += int(count[i]) * times
            slots.append((int(i) + 1, first, int(seen[i]), int(count[i]), sequence))
        sequence += times
    before = Window.partitionBy("size").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("size", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    own = Window.partitionBy("size", "shard").orderBy("doc_id", "start", "ids_crc32")
    ranked = piece.withColumn("own", F.row_number().over(own) - 1).join(base, ["size", "shard"]).withColumn("rank", F.col("base") + F.col("own"))
    # An Arrow table is read in the JVM: rows would go through Python workers, which then stay beside those of the texts.
    slot = spark.createDataFrame(pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*slots, strict=True) if slots else [[]] * 5, _SLOTS.types, strict=True)], schema=_SLOTS))
    # A row per size, so that a piece meets one row; it holds at most one slot for each pattern, of which there are hardly more than sizes.
    slot = slot.groupBy("size").agg(F.collect_list(F.struct("first", "past", "each", "sequence")).alias("slots"))
    placed = ranked.join(F.broadcast(slot), "size").withColumn("own", F.expr("filter(slots, s -> rank >= s.first and rank < s.past)[0]"))
    placed = placed.withColumn("sequence_id", F.expr("own.sequence + (rank - own.first) div own.each")).withColumn("place", F.expr("(rank - own.first) % own.each"))
    earlier = Window.partitionBy("sequence_id").orderBy(F.desc("size"), "place").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", F.coalesce(F.sum("length").over(earlier), F.lit(0)).alias("offset"))


def query(spark, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
