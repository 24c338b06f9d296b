"""Queries on points and vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import spatial as X
from tessera.operators.scratch import Scratch
from tessera.sources.tables import table

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


_POINTS = "select o_orderkey as id, o_orderstatus as part, (o_orderkey * 7919 % 10007) / 10007.0::double as x, (o_orderkey * 104729 % 9973) / 9973.0::double as y, 0.002 * pow(1.7, o_orderkey % 6) as width from orders"


def points(spark, d):
    k = F.col("o_orderkey")
    return table(spark, d, "orders").select(k.alias("id"), F.col("o_orderstatus").alias("part"), (k * 7919 % 10007 / 10007).alias("x"), (k * 104729 % 9973 / 9973).alias("y"), (0.002 * F.pow(F.lit(1.7), k % 6)).alias("width"))


@query(f"""with p as ({_POINTS}) select a.id, a.part, count(b.id) as density from p a left join p b on a.part = b.part and pow(a.x - b.x, 2) + pow(a.y - b.y, 2) <= pow(b.width * 0.3, 2) group by 1, 2""")
def disc_density(spark, d):
    p = points(spark, d)
    return X.disc_density(p.select("id", "part", "x", "y"), p.select("part", "x", "y", "width"), "part")


@query(f"""with p as ({_POINTS}) select a.id as a, b.id as b from p a join p b on a.part = b.part and a.id < b.id
where greatest(a.width, b.width) <= 1.5 * least(a.width, b.width) and sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2)) <= 0.5 * least(a.width, b.width)""")
def neighbour_pairs(spark, d):
    return X.neighbour_edges(points(spark, d), "part")


@query(f"""with recursive p as ({_POINTS}), e as (select a.id as a, b.id as b from p a join p b on a.part = b.part and a.id <> b.id
where greatest(a.width, b.width) <= 1.5 * least(a.width, b.width) and sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2)) <= 0.5 * least(a.width, b.width)),
r as (select id, id as c from p union select r.id, e.b from r join e on r.c = e.a)
select id, min(c) as component from r group by id""")
def band_groups(spark, d):
    return X.neighbour_groups(points(spark, d), "part", Scratch(spark, "groups"))


@query("""with v as (select vec_id, embedding from embeddings), a as (select embedding as e from v where vec_id = 7)
select vec_id, round(list_distance(embedding::double[], e::double[]), 6) as distance from v, a order by case when vec_id = 7 then 0 else 1 end, list_distance(embedding::double[], e::double[]), vec_id limit 32""")
def knn_embeddings(spark, d):
    v = table(spark, d, "embeddings")
    anchor = v.where("vec_id = 7").select(F.col("embedding").alias("e"))
    gap = X.distance(F.col("embedding"), F.col("e"))
    return v.crossJoin(F.broadcast(anchor)).select("vec_id", gap.alias("distance")).orderBy(F.when(F.col("vec_id") == 7, 0).otherwise(1), "distance", "vec_id").limit(32).select("vec_id", F.round("distance", 6).alias("distance"))  # one anchor


@query("""with s as (select vec_id, label, embedding from embeddings), p as (select a.label, list_distance(a.embedding::double[], b.embedding::double[]) as g from s a join s b on a.label = b.label and a.vec_id < b.vec_id)
select label, round(min(g), 6) as closest, round(avg(g), 6) as mean, round(max(g), 6) as widest, count(*) as pairs from p group by label""")
def palette_tightness(spark, d):
    got = X.pair_spread(table(spark, d, "embeddings"), "label", "vec_id", "embedding")
    return got.select("label", *[F.round(c, 6).alias(c) for c in ("closest", "mean", "widest")], "pairs")
