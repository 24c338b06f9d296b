"""MinHash near-duplicate detection by bottom-k sketches from one hash function."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.components import components, group_by_links
from tessera.llm.scratch import Scratch, free, is_empty, small
from tessera.llm.words import shingles, slices, words_of

#: Values that a document retains, as a multiple of its prefix, so that frequent ones can give way to others.
SPARE = 1.25
#: A value is frequent if so many sets retain it; the most frequent MOST at most are known as such to every task (1.6 MB).
FREQUENT, MOST = 32, 200_000
#: 64-bit words of a set's parity sketch.
WORDS = 4
_BITS = [f"b{k}" for k in range(WORDS)]
#: 64-bit words of the longer parity sketch of the sets that are compared, which bounds large sets too.
LONG = 64


def prefix_length(n, threshold: float):
    """Values of a set of ``n`` of which one at least is among the like values of any set of Jaccard similarity
    ``threshold`` or more, whatever the common order that both sets are in."""
    return n - np.ceil(n * threshold - 1e-9).astype(np.int64) + 1


def parities(values: np.ndarray, words: int) -> np.ndarray:
    """Of each of 64 * ``words`` groups of values, whether a set holds an odd number: two sets differ in as many values at
    least as they do in groups."""
    return np.bincount((values & np.uint64(64 * words - 1)).astype(np.int64), minlength=64 * words) & 1


def _compared(width: int, ids: str):
    """Sizes, long parity sketches and all values of the sets of some texts."""
    schema = pa.schema([(ids, pa.int64()), ("n_shingles", pa.int64()), ("parity", pa.list_(pa.int64())), ("vals", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1, 256, 1 << 20):
            words = words_of(batch.column(1))
            sets = [np.unique(shingles(own, width)) for own in np.split(words.numbers, np.searchsorted(words.text, np.arange(1, batch.num_rows)))]
            sizes = np.array([len(x) for x in sets], np.int64)
            odd = np.array([parities(x, LONG) for x in sets], np.uint8).reshape(len(sets), 64 * LONG)
            lists = lambda values, each: pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(each)).astype(np.int32)), pa.array(values))
            sketch = lists(np.packbits(odd, axis=1).view(np.int64).ravel(), np.full(len(sets), LONG))
            flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes), sketch, lists(flat, sizes)], schema=schema)

    return run, f"{ids} long, n_shingles long, parity array<long>, vals array<long>"


def _sets(width: int, retained: float | None, ids: str):
    """Sizes, checks, parity sketches and the smallest values (all, if ``retained`` is null) of the sets of some texts."""
    bits = [(b, pa.int64()) for b in _BITS]
    schema = pa.schema([(ids, pa.int64()), ("n_shingles", pa.int64()), ("sum", pa.int64()), ("xor", pa.int64()), *bits, ("vals", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1, 256, 1 << 20):
            sizes, sums, xors, odd, vals = [], [], [], [], []
            words = words_of(batch.column(1))
            for numbers in np.split(words.numbers, np.searchsorted(words.text, np.arange(1, batch.num_rows))):
                got = np.unique(shingles(numbers, width))
                n = len(got)
                sizes.append(n)
                sums.append(np.add.reduce(got, dtype=np.uint64))
                xors.append(np.bitwise_xor.reduce(got) if n else 0)
                odd.append(parities(got, WORDS))
                vals.append((got if retained is None or not n else got[: int(np.ceil(SPARE * prefix_length(np.int64(n), retained)))]).view(np.int64))
            offsets = np.concatenate([[0], np.cumsum([len(v) for v in vals])]).astype(np.int32)
            flat = np.concatenate(vals) if vals else np.zeros(0, np.int64)
            parity = np.packbits(np.array(odd, np.uint8).reshape(len(sizes), 64 * WORDS), axis=1).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(np.array(sums, np.uint64).view(np.int64)),
                    pa.array(np.array(xors, np.uint64).view(np.int64)),
                    *[pa.array(parity[:, k].copy()) for k in range(WORDS)],
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                ],
                schema=schema,
            )

    return run, f"{ids} long, n_shingles long, sum long, xor long, " + "".join(f"{b} long, " for b in _BITS) + "vals array<long>"


def _prefixes(threshold: float, frequent: np.ndarray, complete: bool):
    """Places of the values in each set's prefix; a place of 0 for a set whose retained values don't make up one.

    The common order is by value, the ``frequent`` ones (sorted) last.
    """
    schema = pa.schema([("key", pa.int64()), ("id", pa.int64()), ("place", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(at, 1024) for whole in batches for at in range(0, whole.num_rows, 1024)):
            ids, n = (batch.column(k).to_numpy() for k in (0, 1))
            lists = batch.column(2)
            sizes = pc.list_value_length(lists).to_numpy().astype(np.int64)
            flat = lists.flatten().to_numpy().view(np.uint64)
            doc = np.repeat(np.arange(len(n)), sizes)
            often = np.zeros(len(flat), bool)
            if len(frequent) and len(flat):
                often = frequent[np.minimum(np.searchsorted(frequent, flat), len(frequent) - 1)] == flat
            seldom = np.bincount(doc[~often], minlength=len(n))
            # Values are sorted within each set: a stable sort puts its frequent ones after the others.
            order = np.lexsort((often, doc))
            place = np.empty(len(flat), np.int64)
            place[order] = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + 1
            need = prefix_length(n, threshold)
            enough = np.full(len(n), True) if complete else (seldom >= need) | (sizes >= n)
            take = enough[doc] & (place <= need[doc])
            short = np.flatnonzero(~enough)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([flat[take].view(np.int64), np.zeros(len(short), np.int64)])),
                    pa.array(np.concatenate([ids[doc[take]], ids[short]])),
                    pa.array(np.concatenate([place[take], np.zeros(len(short), np.int64)]).astype(np.int32)),
                ],
                schema=schema,
            )

    return run, "key long, id long, place int"


def distinct_lists(lists: DataFrame) -> DataFrame:
    """Of the inverted lists ``(key, id, place)`` those of several ids, and of equal lists the first in the common order.

    Near copies share many values, and so lists with the same members. Where two sets share a value of each, they have
    them in the same order, so the first one's places bound what they share.
    """
    one = lists.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count("*").alias("n"), F.bit_xor(F.xxhash64("id")).alias("ids"), F.min("place").alias("place"))
    first = one.where("low < high").groupBy("low", "high", "n", "ids").agg(F.min_by("key", F.struct("place", "key")).alias("key"))
    return lists.join(first.select("key"), "key")


def near_duplicates(docs: DataFrame, threshold: float = 0.85, width: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_shingles, component_id, kept)`` for each row of ``docs``.

    Words are what ASCII white space parts, with A-Z lowered; a document's set is its distinct runs of ``width``
    words, or the whole sequence if it is shorter. Documents of Jaccard similarity ``threshold`` or more are linked;
    the component is the smallest id reachable, and the document with that id is kept.

    Copies of one set are first merged to one representative by count, sum and exclusive or of their shingles. Each
    representative retains the smallest hashes of its set, in proportion to its size: in any common order, two linked
    sets share one of their first n - ceil(threshold * n) + 1 values, so no link is lost to chance. The order is by
    hash, values that many sets retain last; sets of which those leave too few are ordered as a whole. The first
    values enter inverted lists. Pairs from a list pass bounds by size, by place in the order, and by the size of
    the union that parity sketches of both sets prove, a short one in the lists and a longer one of the pairs that pass
    it; then the exact Jaccard similarity of the full sets decides.

    Null or empty text has no shingles and links with nothing. Rows with a null id get a null component and are
    kept. Rows that repeat an id are one vertex with the texts of all. An empty table gives an empty result; other
    columns are ignored.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "near")
    run, schema = _sets(width, threshold, "id")
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    whole = scratch.keep(source.mapInArrow(run, schema))
    firsts = [F.first(c).alias(c) for c in ("vals", *_BITS)]
    rep = whole.where("n_shingles > 0 and id is not null").groupBy("n_shingles", "sum", "xor").agg(F.min("id").alias("rep"), *firsts)
    sketch = scratch.keep(whole.select("id", "n_shingles", "sum", "xor"))
    full_rep = scratch.keep(rep)
    scratch.drop(whole)
    rep = scratch.keep(full_rep.drop("vals"))
    scratch.settle()
    held = scratch.keep(full_rep.select(F.explode("vals").alias("key")).groupBy("key").agg(F.count("*").alias("n")).where("n > 1"))
    often = held.where(F.col("n") >= FREQUENT).orderBy(F.desc("n"), "key").limit(MOST).select("key").toPandas()["key"]
    often = np.sort(often.to_numpy(np.int64).view(np.uint64))
    run, schema = _prefixes(threshold, often, False)
    placed = scratch.keep(full_rep.select("rep", "n_shingles", "vals").mapInArrow(run, schema))
    scratch.drop(full_rep)
    lists = placed.where("place > 0")
    short = scratch.keep(placed.where("place = 0").select("id").distinct())
    run_whole, whole_schema = _sets(width, None, "id")

    def full(ids: DataFrame) -> DataFrame:
        return source.join(small(ids), "id", "left_semi").mapInArrow(run_whole, whole_schema)

    several = held.select("key")
    if not is_empty(short):
        run, schema = _prefixes(threshold, often, True)
        # Written in between: two functions in one task would take two Python workers, and an executor keeps all it ever had.
        whole = scratch.keep(full(short).where("n_shingles > 0").select("id", "n_shingles", "vals"))
        late = scratch.keep(whole.mapInArrow(run, schema))
        scratch.drop(whole)
        lists = lists.unionByName(late)
        several = several.unionByName(late.select("key")).distinct()
    lists = scratch.keep(lists.join(small(scratch.keep(several)), "key"))
    scratch.drop(placed, held)
    scratch.settle()
    lists = scratch.keep(distinct_lists(lists))
    parity = rep.groupBy(F.col("rep").alias("id")).agg(F.count("*").alias("sets"), F.max("n_shingles").alias("n_shingles"), *[F.first(b).alias(b) for b in _BITS])
    # An id with several texts has no one size and sketch: none bounds it.
    parity = parity.select("id", *[F.when(F.col("sets") == 1, F.col(b)).alias(b) for b in ("n_shingles", *_BITS)])
    lists = scratch.keep(lists.join(parity, "id"))
    scratch.settle()
    need = threshold - 1e-12

    def near(a: str, b: str):
        na, nb = F.col(f"{a}n_shingles"), F.col(f"{b}n_shingles")
        # Sharing k values, the sets share those before this one, at most, which other rows show, and those from here on.
        most = F.least(na - F.col(f"{a}place"), nb - F.col(f"{b}place")) + 1
        apart = sum((F.bit_count(F.col(f"{a}{c}").bitwiseXOR(F.col(f"{b}{c}"))) for c in _BITS), F.lit(0))
        small_enough = (na + nb - apart) >= (na + nb + apart) * need
        return F.coalesce((F.least(na, nb) >= F.greatest(na, nb) * need) & (most >= (na + nb - most) * need) & small_enough, F.lit(True))

    def may(a: str, b: str):
        na, nb = F.col(f"{a}n_shingles"), F.col(f"{b}n_shingles")
        each = F.zip_with(F.col(f"{a}parity"), F.col(f"{b}parity"), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
        apart = F.aggregate(each, F.lit(0), lambda total, x: total + x)
        return (na + nb - apart) >= (na + nb + apart) * need

    def linked(a: str, b: str):
        both = F.size(F.array_intersect(f"{a}vals", f"{b}vals"))
        return both >= (F.col(f"{a}n_shingles") + F.col(f"{b}n_shingles") - both) * need

    run_compared, compared_schema = _compared(width, "id")

    def compared(ids: DataFrame) -> DataFrame:
        return source.join(small(ids), "id", "left_semi").mapInArrow(run_compared, compared_schema)

    group = group_by_links(lists, compared, linked, near, scratch, bound=(["n_shingles", "parity"], may))
    # Representative -> component; then every document through its own representative. An id with several texts
    # joins their representatives.
    of_rep = rep.select("n_shingles", "sum", "xor", "rep").join(group.select(F.col("id").alias("rep"), "component"), "rep", "left")
    of_rep = of_rep.select("n_shingles", "sum", "xor", "rep", F.coalesce("component", "rep").alias("component"))
    out = sketch.select("id", "n_shingles", "sum", "xor").join(of_rep, ["n_shingles", "sum", "xor"], "left")
    twice = sketch.where("id is not null").groupBy("id").count().where("count > 1")
    out = scratch.keep(out.select("id", "n_shingles", F.coalesce("component", "id").alias("component_id")))
    read = [out]
    if twice.limit(1).count():
        edges = out.join(twice.select("id"), "id", "left_semi").select(F.col("id").alias("a"), F.col("component_id").alias("b"))
        joined = scratch.keep(components(edges.unionByName(out.select(F.col("id").alias("a"), F.col("component_id").alias("b"))), scratch))
        read.append(joined)
        out = out.drop("component_id").join(joined, "id", "left").select("id", "n_shingles", F.coalesce("component", "id").alias("component_id"))
    scratch.only(*read)
    return out.select(F.col("id").alias(id_col), "n_shingles", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, threshold: float = 0.8, width: int = 5) -> DataFrame:
    """``docs`` with one document of each near-duplicate group: the one with the smallest ``doc_id``; rows without
    an id and rows that repeat the kept id stay. Same columns."""
    verdict = near_duplicates(docs, threshold, width).where("not kept").select("doc_id").distinct()
    gone = free(docs, "gone")
    return docs.join(verdict.withColumnRenamed("doc_id", gone), docs["doc_id"].cast("long") == F.col(gone), "left_anti")


def query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
