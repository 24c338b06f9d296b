"""Shared steps of the line and the paragraph operator: units of text, groups of near-equal ones, the first kept."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.components import group_by_links
from tessera.llm.scratch import Scratch, small
from tessera.llm.words import mix, slices

_STEP = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))
UNIT = "doc_id long, unit int, h1 long, h2 long"


def sequence_hashes(numbers: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each run of word hashes; ``starts`` are the runs' first positions."""
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    sizes = np.diff(np.append(starts, len(numbers)))
    place = (np.arange(len(numbers)) - np.repeat(starts, sizes)).astype(np.uint64)
    return tuple(np.add.reduceat(mix(numbers ^ (place * step + step)), starts) for step in _STEP)  # type: ignore[return-value]


def by_documents(unit_batch: Callable, schema: pa.Schema):
    """A mapInArrow function that gives ``unit_batch`` the ids and texts of some documents at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1, 512, 1 << 21):
            got = unit_batch(batch)
            if got[0] is not None and len(got[0]):
                yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, t) for x, t in zip(got, schema.types, strict=True)], schema=schema)

    return run


def removals(
    units: DataFrame,
    payload: Callable[[DataFrame], DataFrame],
    scratch: Scratch,
    **link,
) -> DataFrame:
    """``(doc_id, gone array<int>)``: the units of each document that repeat an earlier one.

    ``units(doc_id, unit, h1, h2, keys, *small)``, a kept table that is deleted once it is read, is every unit with the
    keys of the inverted lists that it is in and the small columns that comparing two needs. Equal hashes are one text;
    ``payload`` gives what else comparing some texts needs, from ``(doc_id, units array<struct<h1, h2, unit>>)``. Of each
    connected group of texts the occurrence with the smallest document and place stays.
    """
    first = F.min(F.struct("doc_id", "unit")).alias("first")
    small_columns = [c for c in units.columns if c not in ("doc_id", "unit", "h1", "h2", "keys")]
    every, units = units, scratch.keep(units.select("doc_id", "unit", "h1", "h2"))
    twice = scratch.keep(units.groupBy("h1", "h2").agg(first, F.count("*").alias("n")).where("n > 1"))
    # A key of one text alone links nothing: keys are looked at before anything else moves, and nothing moves with them
    # but the text's name. They are joined by a shuffle at any size, since they grow with the units.
    keyed = every.select(F.explode("keys").alias("key"), "h1", "h2")
    several = scratch.keep(keyed.groupBy("key").agg(F.min("h1").alias("low"), F.max("h1").alias("high")).where("low < high").select("key"))
    listed = scratch.keep(keyed.join(several.hint("merge"), "key").distinct())
    # Near copies share many keys: of lists with the same members one is enough.
    own = F.xxhash64("h1", "h2")
    one = listed.groupBy("key").agg(F.count("*").alias("n"), F.bit_xor(own).alias("x"), F.min(own).alias("low"), F.max(own).alias("high"))
    listed = scratch.keep(listed.join(one.groupBy("n", "x", "low", "high").agg(F.min("key").alias("key")).select("key"), "key"))
    some = scratch.keep(listed.select("h1", "h2").distinct())
    small_of = scratch.keep(every.select("h1", "h2", *small_columns).join(small(some, F.lit(2)), ["h1", "h2"]).dropDuplicates(["h1", "h2"]))
    listed = scratch.keep(listed.join(small(small_of, F.lit(2 + len(small_columns))), ["h1", "h2"]).select("key", F.struct("h1", "h2").alias("id"), *small_columns))
    scratch.drop(every, some, small_of)
    scratch.settle()

    def firsts(ids: DataFrame) -> DataFrame:
        some = small(ids, F.lit(2))
        return units.select("doc_id", "unit", "h1", "h2").join(some, ["h1", "h2"]).groupBy("h1", "h2").agg(first, F.count("*").alias("n"))

    def of(ids: DataFrame) -> DataFrame:
        wanted = firsts(ids.select("id.h1", "id.h2")).select("h1", "h2", "first.doc_id", "first.unit")
        per_doc = scratch.keep(wanted.groupBy("doc_id").agg(F.collect_list(F.struct("h1", "h2", "unit")).alias("units")))
        return payload(small(per_doc, F.size("units") * 3))

    group = group_by_links(listed, of, scratch=scratch, **link)
    group = scratch.keep(group.select("id.h1", "id.h2", "component"))
    linked = firsts(group.select("h1", "h2")).join(group, ["h1", "h2"])
    alone = twice.join(group, ["h1", "h2"], "left_anti").withColumn("component", F.struct("h1", "h2"))
    joined = scratch.keep(linked.select("h1", "h2", "first", "component").unionByName(alone.select("h1", "h2", "first", "component")))
    keep = joined.groupBy("component").agg(F.min("first").alias("keep"))
    marked = scratch.keep(joined.join(keep, "component").select("h1", "h2", "keep"))
    gone = units.select("doc_id", "unit", "h1", "h2").join(small(marked, F.lit(4)), ["h1", "h2"]).where("doc_id <> keep.doc_id or unit <> keep.unit")
    return gone.groupBy("doc_id").agg(F.sort_array(F.collect_set("unit")).alias("gone"))
