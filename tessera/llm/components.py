"""Connected components of an edge table, and exact grouping of near-equal items through inverted lists."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.scratch import Scratch, is_empty
from tessera.llm.scratch import small as small_side
from tessera.operators.spatial import components as star_components


#: Distinct edges that one task joins by union-find; with more, steps over the whole cluster do.
LOCAL = 200_000


def _union_find(edge: DataFrame) -> DataFrame:
    """``(id, component)`` of at most LOCAL edges ``(u, v)``, in one task."""
    kind = edge.schema["u"].dataType.simpleString()

    def run(batches):
        parent: dict = {}

        def find(x):
            parent.setdefault(x, x)
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        schema, struct = None, None
        for batch in batches:
            schema = batch.schema.field(0).type
            struct = schema.names if pa.types.is_struct(schema) else None
            for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if struct:
                    u, v = (tuple(x[n] for n in struct) for x in (u, v))
                a, b = find(u), find(v)
                parent[max(a, b)] = min(a, b)
        if parent:
            ids = list(parent)
            back = (lambda x: dict(zip(struct, x, strict=True))) if struct else (lambda x: x)
            columns = [pa.array([back(x) for x in c], schema) for c in (ids, map(find, ids))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "component"])

    return edge.select("u", "v").coalesce(1).mapInArrow(run, f"id {kind}, component {kind}")


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``(id, component)`` for every vertex of ``edges(a, b)``; the component is its smallest id.

    Up to LOCAL distinct edges, counted first, are joined in one task; the result is the same either way.

    Alternates large-star and small-star steps until nothing changes. A step is a minimum per vertex, which Spark
    combines before it shuffles, joined back to the edges, so no vertex's neighbours are ever gathered in one row.
    Loops, repeated edges and nulls are ignored; no edges give no rows.
    """
    edge = (
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("u > v")
        .distinct()
    )
    edge = scratch.keep(edge)
    if edge.count() <= LOCAL:
        return scratch.keep(_union_find(edge))
    return star_components(edge.select(F.col("u").alias("a"), F.col("v").alias("b")), scratch)


def group_is_kept(frame: DataFrame) -> bool:
    return hasattr(frame, "_tessera_path")


def group_by_links(
    members: DataFrame,
    payload: Callable[[DataFrame], DataFrame],
    linked: Callable[[str, str], Column],
    near: Callable[[str, str], Column] | None,
    scratch: Scratch,
    stars: tuple[int, ...] = (1, 16),
    check: Callable[[DataFrame], DataFrame] | None = None,
    bound: tuple[list[str], Callable[[str, str], Column]] | None = None,
) -> DataFrame:
    """Components ``(id, component)`` of the graph that joins two ids if they share a key and ``linked`` holds.

    ``members(key, id, *small)`` are inverted lists; ``payload`` gives what a comparison needs, ``(id, *large)``, of the
    ids of the pairs to compare, a kept table. Columns reach ``linked`` prefixed ``l_`` and ``r_``; ``near`` is a condition on the small columns alone, under the same names.

    Components need no all-pairs join. In each star round a list compares its members with some hubs among them (the
    smallest id first, then ``stars`` others chosen by hash, in lists longer than that); lists whose members already
    share a component drop out. What is left, lists that still span several components, is compared pair by pair
    across components, so the result is the one that all pairs would give. ``check`` verifies pairs where a column
    expression can't. ``bound`` names columns of ``payload`` that are short, and a condition on them, under the same
    prefixes, that all linked pairs meet: the other columns move for the pairs that meet it alone. Where no hub is near to anything, members of its list may be near each other still: the round
    that compares all always runs.
    """
    small = [c for c in members.columns if c not in ("key", "id")]
    near = near or (lambda left, right: F.lit(True))
    group = None

    def verified(pairs: DataFrame) -> DataFrame:
        ids = scratch.keep(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct())
        wide = scratch.keep(payload(ids))
        made = [ids, wide]

        def both(pairs: DataFrame, wide: DataFrame, columns: list[str]) -> DataFrame:
            left = wide.select(F.col("id").alias("a"), *[F.col(c).alias(f"l_{c}") for c in columns])
            right = wide.select(F.col("id").alias("b"), *[F.col(c).alias(f"r_{c}") for c in columns])
            return pairs.join(right, "b").join(left, "a")

        columns = [c for c in wide.columns if c != "id"]
        if bound:
            short, may = bound
            pairs = scratch.keep(both(pairs, wide, short).where(may("l_", "r_")).select(*pairs.columns))
            some = scratch.keep(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct())
            made += [pairs, some]
            wide = wide.join(small_side(some), "id", "left_semi")
        whole = both(pairs, wide, columns)
        good = scratch.keep((check(whole) if check else whole.where(linked("l_", "r_"))).select("l_c", "r_c").distinct())
        scratch.drop(*made)
        return good

    for turn, hubs in enumerate((*stars, None)):
        lab = members if group is None else members.join(group.withColumnRenamed("component", "c"), "id", "left")
        lab = lab.withColumn("c", F.col("id") if group is None else F.coalesce("c", "id"))
        mixed = lab.groupBy("key").agg(F.min("c").alias("c_low"), F.max("c").alias("c_high"), F.count("*").alias("n")).where("c_low < c_high")
        # A short list has few pairs: it isn't worth more than one hub.
        mixed = mixed.where(F.col("n") > (hubs if hubs and hubs > 1 else 1)).select("key")
        rest = scratch.keep(lab.join(mixed, "key", "left_semi"))
        left = rest
        if hubs:
            # Most lists choose the same hubs, and only so many of a task's rows move.
            first = Window.partitionBy("key").orderBy(F.col("id") if turn == 0 else F.xxhash64("id", F.lit(turn)), "id")
            left = rest.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= hubs).drop("_n")
        left = left.select("key", F.col("id").alias("a"), F.col("c").alias("l_c"), *[F.col(c).alias(f"l_{c}") for c in small])
        right = rest.select("key", F.col("id").alias("b"), F.col("c").alias("r_c"), *[F.col(c).alias(f"r_{c}") for c in small])
        once = F.col("l_c") != F.col("r_c") if hubs else F.col("l_c") < F.col("r_c")
        pairs = left.join(right, "key").where(once & near("l_", "r_"))
        swap = F.col("a") > F.col("b")
        pairs = pairs.select(*[F.when(swap, F.col(y)).otherwise(F.col(x)).alias(x) for x, y in (("a", "b"), ("b", "a"), ("l_c", "r_c"), ("r_c", "l_c"))])
        pairs = scratch.keep(pairs.distinct())
        scratch.drop(rest)
        if is_empty(pairs):
            continue
        # Links join the components found so far: what is left to group is small after the first round.
        found = verified(pairs)
        scratch.drop(pairs)
        scratch.settle()
        more = components(found.select(F.col("l_c").alias("a"), F.col("r_c").alias("b")), scratch)
        if not group_is_kept(more):
            more = scratch.keep(more)
        if group is None:
            group = more
            continue
        new = more.select(F.col("id").alias("component"), F.col("component").alias("new"))
        moved = group.join(new, "component", "left").select("id", F.coalesce("new", "component").alias("component"))
        group = scratch.keep(moved.unionByName(more.join(group.select("id"), "id", "left_anti").select("id", "component")))
    return group if group is not None else members.select("id", F.col("id").alias("component")).where("false")
