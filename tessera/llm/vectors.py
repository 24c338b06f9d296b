"""Vectors that take part in a search, and sets of queries against all of them, block by block."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def usable(table: DataFrame, zero: bool) -> DataFrame:
    """``(vec_id long, embedding array<float>)``: rows with an id and a finite vector, of the commonest length.

    Of rows that repeat an id the one with the smallest vector counts. ``zero`` says whether zero vectors take part.
    """
    good = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>").alias("embedding"))
    good = good.where("vec_id is not null and embedding is not null and size(embedding) > 0")
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = good.where(F.coalesce(fine, F.lit(False)))
    if not zero:
        good = good.where(F.exists("embedding", lambda x: x != 0))
    sizes = good.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    good = good.where(F.size("embedding") == (sizes[0]["n"] if sizes else 0))
    return good.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def packed(rows: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.StructArray]:
    """Ids and vectors of one ``list<struct<vec_id, embedding, ...>>``."""
    ids = rows.field("vec_id").to_numpy(zero_copy_only=False)
    flat = rows.field("embedding").flatten().to_numpy(zero_copy_only=False)
    return ids, flat.reshape(len(ids), -1), rows


def nearest_first(found: DataFrame, k: int, order) -> DataFrame:
    own = Window.partitionBy("query_id").orderBy(order, "vec_id")
    return found.withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
