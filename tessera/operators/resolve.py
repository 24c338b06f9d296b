"""Resolution of append-only stores: latest wins, first writer wins, precedence, change classes, merges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(rows: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The last row of each key by ``order`` (ascending, so the greatest wins), with ``superseded``, the rows it replaced.

    Rows with a null in the key resolve to nothing and are left out, as a reader of the store counts but never keeps
    them. The aggregate keeps one struct per key and combines before the shuffle; no window sorts whole keys.
    """
    whole = F.struct(*rows.columns)
    good = rows.dropna(subset=key)
    best = good.groupBy(*key).agg(F.max_by(whole, F.struct(*order)).alias("_row"), F.count("*").alias("_n"))
    return best.select("_row.*", (F.col("_n") - 1).alias("superseded"))


def first_writer(rows: DataFrame, key: Column, order: list[Column]) -> DataFrame:
    """The first row of each key by ``order``; rows without a key all stay."""
    whole = F.struct(*rows.columns)
    keyed = rows.withColumn("_key", key)
    kept = keyed.where("_key is not null").groupBy("_key").agg(F.min_by(whole, F.struct(*order)).alias("_row"), F.count("*").alias("_n"))
    alone = keyed.where("_key is null").select(whole.alias("_row"), F.lit(1).cast("long").alias("_n"))
    return kept.select("_row", "_n").unionByName(alone).select("_row.*", F.col("_n").alias("copies"))


def without(rows: DataFrame, stronger: DataFrame, key: list[str]) -> DataFrame:
    """Rows that no row of ``stronger`` suppresses; a null key is never suppressed."""
    return rows.join(stronger.select(*key).distinct(), key, "left_anti")


def change_class(current: DataFrame, incoming: DataFrame, key: list[str], compare: list[str]) -> DataFrame:
    """Each incoming key as fresh, revised or unchanged against the current store, nulls equal to nulls."""
    now = current.select(*key, F.struct(*compare).alias("_now"))
    new = incoming.select(*key, F.struct(*compare).alias("_new"))
    both = new.join(now, key, "left")
    kind = F.when(F.col("_now").isNull(), "fresh").when(F.col("_now").eqNullSafe(F.col("_new")), "unchanged").otherwise("revised")
    return both.select(*key, kind.alias("change"))


def upsert(current: DataFrame, incoming: DataFrame, key: list[str], carried: list[str]) -> DataFrame:
    """Incoming rows win by key; columns in ``carried`` keep their old value where the new one is null."""
    old, new = current.alias("old"), incoming.alias("new")
    on = None
    for k in key:
        same = F.col(f"old.{k}") == F.col(f"new.{k}")
        on = same if on is None else on & same
    has_new = F.col(f"new.{key[0]}").isNotNull()
    out = []
    for c in current.columns:
        pick = F.when(has_new, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}"))
        if c in carried:
            pick = F.coalesce(F.col(f"new.{c}"), F.col(f"old.{c}"))
        out.append(pick.alias(c))
    return old.join(new, on, "full").select(*out)


def replace_scope(current: DataFrame, incoming: DataFrame, scope: list[str]) -> DataFrame:
    """All rows whose scope is among those of ``incoming`` give way to it; the others stay."""
    return current.join(incoming.select(*scope).distinct(), scope, "left_anti").unionByName(incoming)


def compared(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Full outer comparison of keys: gained, lost or kept."""
    a, b = old.select(*key).distinct().withColumn("_old", F.lit(True)), new.select(*key).distinct().withColumn("_new", F.lit(True))
    both = a.join(b, key, "full")
    return both.select(*key, F.when(F.col("_old").isNull(), "gained").when(F.col("_new").isNull(), "lost").otherwise("kept").alias("state"))


def aligned(first: DataFrame, others: list[DataFrame], key: str) -> DataFrame:
    """Inner join of several reads of one sample; raises, when run, unless each covers exactly the same keys."""
    out, n = first, first.select(key).distinct().count()
    for other in others:
        out = out.join(other, key)
        if other.select(key).distinct().count() != n:
            raise ValueError(f"reads don't cover the same {key}s")
    if out.count() != n:
        raise ValueError(f"reads don't share their {key}s")
    return out


def owner(rows: DataFrame, key: str, batch: str, eligible: Column) -> DataFrame:
    """The first batch by name that isn't eligible, else the first; eligible only if all contributors are."""
    agg = rows.groupBy(key).agg(F.coalesce(F.min(F.when(~eligible, F.col(batch))), F.min(batch)).alias("owner"), F.every(eligible).alias("eligible"))
    return agg


def row_number(partition: list, order: list) -> Column:
    return F.row_number().over(Window.partitionBy(*partition).orderBy(*order))
