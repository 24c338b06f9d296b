"""Exact top-k inner products by block-at-a-time pruning."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.scratch import partitions
from tessera.llm.vectors import nearest_first, packed, usable

#: Rows of a shard (on average) and of a block, queries of a batch (on average).
SHARD, BLOCK, QUERIES = 8192, 256, 256


def search_blocks(queries: np.ndarray, q_ids: np.ndarray, weights: np.ndarray, ids: np.ndarray, k: int, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray, int]:
    """Ids and scores, best first, of each query's ``k`` best rows; the number of block and query pairs scored.

    Terms are dimensions. A block of consecutive documents keeps each term's largest and smallest weight, whose
    product with the query's weight bounds what the term adds. Each query takes blocks by falling bound and stops
    when a block's bound is below its kth score; an equal bound may still hold a tie with a smaller id.
    """
    n, m = len(ids), len(q_ids)
    starts = np.arange(0, n, block)
    high, low = np.maximum.reduceat(weights, starts, axis=0), np.minimum.reduceat(weights, starts, axis=0)
    bound = np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T
    order = np.argsort(-bound, axis=1, kind="stable")
    best = np.full((m, k), -np.inf)
    who = np.full((m, k), np.iinfo(np.int64).max)
    scored = 0
    active = np.arange(m)
    for step in range(len(starts)):
        now = order[active, step]
        active = active[bound[active, now] >= best[active, -1]]
        if not len(active):
            break
        now = order[active, step]
        for b in np.unique(now):
            rows = active[now == b]
            part = slice(starts[b], starts[b] + block)
            got = queries[rows] @ weights[part].T
            own = np.broadcast_to(ids[part], got.shape)
            got = np.where(own == q_ids[rows][:, None], -np.inf, got)
            scores, names = np.concatenate([best[rows], got], 1), np.concatenate([who[rows], np.where(np.isinf(got), np.iinfo(np.int64).max, own)], 1)
            top = np.lexsort((names, -scores), axis=1)[:, :k]
            best[rows], who[rows] = np.take_along_axis(scores, top, 1), np.take_along_axis(names, top, 1)
            scored += len(rows)
    return who, best, scored


def top_inner_products(table: DataFrame, every: int = 20, k: int = 20, scale: float = 64.0) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row whose id is divisible by ``every`` the ``k`` others with the
    largest inner products of the components ``floor(scale * x)``, ties to the smaller id; all, if fewer.

    Documents are parted into shards of some 8,192, by hash of their ids, and queries into batches of some 256; a task
    prunes blocks, ranges of the ids of one shard, for one batch, and each query's best of all shards are merged. Sums are of integers in double precision,
    exact below 2**53. Null vectors, vectors with null or non-finite components and rows without an id take no
    part; neither do vectors of another length than the commonest. A repeated id counts once. No rows, no result.
    """
    good = usable(table, zero=True)
    entry = F.struct("vec_id", "embedding")
    total = good.count()
    if not total:
        return good.select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.col("vec_id").alias("score")).where("false")
    n = -(-total // SHARD)
    shards = good.groupBy(F.pmod(F.xxhash64("vec_id"), F.lit(n)).alias("shard")).agg(F.sort_array(F.collect_list(entry)).alias("rows"))
    asked = good.where(F.col("vec_id") % every == 0)
    groups = -(-total // (QUERIES * every))
    batches = asked.groupBy(F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(groups)).alias("batch")).agg(F.sort_array(F.collect_list(entry)).alias("queries"))
    # The stated query set against all rows, in blocks: every batch meets every shard. Shards are dealt as often as it
    # takes for all tasks to have some, so that a shard's batches aren't one task.
    deal = max(1, min(groups, -(-4 * partitions(table.sparkSession) // n)))
    batches = batches.withColumn("deal", F.col("batch") % deal).withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))))
    shards = shards.withColumn("deal", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(deal - 1).cast("long"))))
    met = batches.join(shards, ["shard", "deal"]).select("queries", "rows")
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                q_ids, q, _ = packed(batch.column(0).slice(i, 1).flatten())
                ids, v, _ = packed(batch.column(1).slice(i, 1).flatten())
                who, best, _ = search_blocks(np.floor(scale * q.astype(float)), q_ids, np.floor(scale * v.astype(float)), ids, k)
                rows, cols = np.nonzero(np.isfinite(best))
                yield pa.RecordBatch.from_arrays([pa.array(q_ids[rows]), pa.array(who[rows, cols]), pa.array(best[rows, cols].astype(np.int64))], schema=schema)

    found = met.mapInArrow(run, "query_id long, vec_id long, score long")
    return nearest_first(found, k, F.desc("score"))


def query(spark, sf_dir: str) -> DataFrame:
    return top_inner_products(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLE = """
with e as (select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as w from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x::double))) = 0),
p as (select q.vec_id as query_id, c.vec_id, list_inner_product(q.w, c.w)::bigint as score
  from e q join e c on q.vec_id % 20 = 0 and c.vec_id <> q.vec_id),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::integer as rank from p)
select query_id, rank, vec_id, score from r where rank <= 20
"""
