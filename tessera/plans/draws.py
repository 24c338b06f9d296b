"""Queries on draws, holdouts, plans and points kept apart."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import draws as D
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


@query("select doc_id, (row_number() over (order by md5('9|' || doc_id), doc_id))::integer as place from documents")
def plan_shuffle(spark, d):
    return D.shuffled(table(spark, d, "documents").select("doc_id"), "doc_id", 9)


@query("""with p as (select p_brand as name from part group by 1), n as (select count(*) as n from p), l as (select name, lap, n from p, n, range(0, 10) r(lap)), o as (select *, lap * n + row_number() over (partition by lap order by md5('5|' || lap || '|' || name), name) as place from l)
select place::integer as place, lap::integer as lap, name from o where place <= 60""")
def anchor_laps(spark, d):
    return D.laps(table(spark, d, "part").select(F.col("p_brand").alias("name")), "name", 60, 5)


@query("""with p as (select distinct l_orderkey from lineitem), h as (select l_orderkey, l_orderkey % 29 = 0 as pin from p), w as (select greatest(1, round_even(count(*) * 0.2, 0)) as want, count(*) filter (pin) as held from h),
o as (select l_orderkey, row_number() over (order by md5('4|' || l_orderkey), l_orderkey) as place from h where not pin), k as (select l_orderkey from o, w where place <= greatest(0, want - held) union all select l_orderkey from h where pin)
select side, count(*) as sets, count(distinct l_orderkey) as places from (select l.l_orderkey, case when k.l_orderkey is null then 'train' else 'holdout' end as side from lineitem l left join k using (l_orderkey)) group by side""")
def set_holdout(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey")
    pins = rows.where("l_orderkey % 29 = 0").distinct()
    return D.holdout(rows, "l_orderkey", pins, 0.2, 4).groupBy("side").agg(F.count("*").alias("sets"), F.count_distinct("l_orderkey").alias("places"))


@query("""with g as (select c_nationkey, count(*) as n from customer group by 1), b as (select *, coalesce(sum(n) over (order by md5('2|' || c_nationkey), c_nationkey rows between unbounded preceding and 1 preceding), 0) as before from g)
select c_nationkey, n, before < (select count(*) * 0.1 from customer) as selected from b""")
def selection_slice(spark, d):
    return D.training_side(table(spark, d, "customer"), "c_nationkey", 0.1, 2)


@query("""with c as (select s_nationkey as part, s_suppkey as k, row_number() over (partition by s_nationkey order by md5('6|' || s_suppkey), s_suppkey) as i from supplier), t as (select part, k from c where i <= 1 + part % 3),
p as (select *, row_number() over (order by md5('7|' || k), k) as place from t) select place::integer as place, part, k, case when place <= (select round_even(count(*) * 0.7, 0) from t) then 'hard' else 'uniform' end as kind from p""")
def corpus_plan(spark, d):
    s = table(spark, d, "supplier").select(F.col("s_nationkey").alias("part"), F.col("s_suppkey").alias("k"))
    quota = s.select("part").distinct().withColumn("quota", 1 + F.col("part") % 3)
    return D.corpus_plan(s, "part", "k", quota, 6).select("place", "part", "k", "kind")


@query("select doc_id, round(1 / sqrt(count(*) over (partition by quality)) * case when toxic = 1 then 0.5 else 1 end, 10) as weight from labels")
def finished_weights(spark, d):
    return D.finished_weights(table(spark, d, "labels"), "quality", F.col("toxic") == 1, 0.5).select("doc_id", F.round("weight", 10).alias("weight"))


@query("""with g as (select doc_id, md5(text) as g from documents where n_chars > 100), s as (select g, count(*) as n from g group by 1)
select count(*) as groups, max(n) as largest, count(*) filter (n = 1) as singletons, (select count(*) from documents where coalesce(n_chars, 0) <= 100) as unplaced from s""")
def group_summary(spark, d):
    docs = table(spark, d, "documents")
    groups = docs.where("n_chars > 100").select("doc_id", F.md5("text").alias("g"))
    return D.group_summary(groups, docs, "doc_id", "g")


@query("select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 100")
def frontier_prune(spark, d):
    return D.pruned(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", "o_orderkey", 100)


@query("""select coalesce(a.k, b.k) as k, case when a.k is not null then 'kept' else 'added' end as state from (select distinct o_custkey as k from orders where o_orderstatus = 'F') a full join (select distinct o_custkey as k from orders where o_orderstatus = 'P') b using (k)""")
def pin_growth(spark, d):
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("k"), "o_orderstatus")
    return D.grown(o.where("o_orderstatus = 'F'"), o.where("o_orderstatus = 'P'"), "k")


@query("select p_type, min(p_partkey) as p_partkey from part group by p_type")
def binding_dedup(spark, d):
    return D.bound(table(spark, d, "part").select("p_partkey", "p_type"), "p_partkey", "p_type").select("p_type", "p_partkey")


@query("select o_orderstatus as name, count(*)::bigint as n from (select o_orderstatus from orders union all select l_linestatus from lineitem) t group by 1")
def sourcing_merge(spark, d):
    one = table(spark, d, "orders").groupBy(F.col("o_orderstatus").alias("name")).agg(F.count("*").alias("n"))
    two = table(spark, d, "lineitem").groupBy(F.col("l_linestatus").alias("name")).agg(F.count("*").alias("n"))
    return D.merged_counts(one, two, "name", "n")


@query("select conv_id, min(case when turn = first then role end) as role from (select *, min(turn) over (partition by conv_id) as first from conversations) c group by 1")
def canonical_slots(spark, d):
    c = table(spark, d, "conversations")
    first = c.groupBy("conv_id").agg(F.min("turn").alias("f"))
    return D.canonical_slot(c.join(first, "conv_id").withColumn("slot", F.col("turn") - F.col("f")), "conv_id", "slot", "role").select("conv_id", "role")


def scattered(spark, d):
    o = table(spark, d, "orders")
    return o.select(F.col("o_orderkey").alias("id"), (F.col("o_custkey") % 7).alias("part"), (F.col("o_totalprice") % 100).alias("x"), (F.col("o_orderkey") * 37 % 10007 / 100.07).alias("y"), F.col("o_orderdate").alias("at"))


@query()
def kept_apart(spark, d):
    return D.kept_apart(scattered(spark, d), "part", "at", 2.5, Scratch(spark, "apart")).select("id", "part")


@query("""with p as (select o_orderkey as id, o_custkey % 7 as part, o_totalprice % 100 as x, o_orderkey * 37 % 10007 / 100.07::double as y from orders), a as (select * from p where id % 40 = 1)
select p.id, p.part, round(min(sqrt(pow(p.x - a.x, 2) + pow(p.y - a.y, 2))), 8) as distance from p left join a on p.part = a.part group by 1, 2""")
def nearest_accepted(spark, d):
    p = scattered(spark, d).drop("at")
    return D.nearest(p, p.where("id % 40 = 1"), "part").select("id", "part", F.round("distance", 8).alias("distance"))


@query()
def focus_draw(spark, d):
    rows = table(spark, d, "part").select(F.col("p_brand").alias("part"), F.col("p_partkey").alias("k"), (F.col("p_retailprice") - 890).alias("score"))
    return D.roulette(rows, "part", "k", "score", 3)


@query("""with t as (select o_custkey as f, (o_orderkey % 8)::integer as tx, (o_orderkey // 8 % 4)::integer as ty, sum(o_totalprice) / 100 as e from orders group by 1, 2, 3),
g as (select f, sum(e) as s, sum(e * (tx + 0.5) / 8) / sum(e) as fx, sum(e * (ty + 0.5) / 4) / sum(e) as fy, arg_max({x: tx, y: ty}, e) as peak from t group by f),
h as (select g.*, e as here from g left join t on g.f = t.f and t.tx = least(floor(fx * 8), 7) and t.ty = least(floor(fy * 4), 3))
select f, round(case when coalesce(here, 0) < 0.5 then (peak.x + 0.5) / 8 else fx end, 8) as fx, round(case when coalesce(here, 0) < 0.5 then (peak.y + 0.5) / 4 else fy end, 8) as fy from h""")
def density_points(spark, d):
    k = F.col("o_orderkey")
    tiles = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("f"), (k % 8).cast("int").alias("tx"), (F.floor(k / 8) % 4).cast("int").alias("ty")).agg((F.sum("o_totalprice") / 100).alias("energy"))
    return D.density_point(tiles, "f", 8, 4, 0.5).select("f", F.round("fx", 8).alias("fx"), F.round("fy", 8).alias("fy"))
