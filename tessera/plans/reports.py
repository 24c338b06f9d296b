"""Queries that account for runs, walks and sets."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators import walk as W
from tessera.operators.spatial import distance
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


@query("""select o_orderpriority as part, count(*) as planned, count(*) filter (o_orderstatus = 'F') as resumed, count(*) filter (o_orderstatus = 'O') as made, count(*) filter (o_orderstatus not in ('F', 'O')) as failed,
  count(*) = count(*) filter (o_orderstatus = 'F') + count(*) filter (o_orderstatus = 'O') + count(*) filter (o_orderstatus not in ('F', 'O')) as balanced from orders group by 1""")
def leg_reconciliation(spark, d):
    s = F.col("o_orderstatus")
    got = table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("part")).agg(F.count("*").alias("planned"), F.count_if(s == "F").alias("resumed"), F.count_if(s == "O").alias("made"), F.count_if(~s.isin("F", "O")).alias("failed"))
    return got.withColumn("balanced", F.col("planned") == F.col("resumed") + F.col("made") + F.col("failed"))


@query("""with s as (select l_returnflag as part, sum(l_tax) as spent, 0.05 * sum(sum(l_tax)) over () as allocated from lineitem group by 1)
select part, round(1 - spent / allocated, 6) as unspent, case when spent = 0 then 'starved' when 1 - spent / allocated >= 0.9 then 'unspent' else 'spent' end as state, round(spent / sum(spent) over (), 6) as realised from s""")
def unspent_floor(spark, d):
    every = Window.partitionBy()
    s = table(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("part")).agg(F.sum("l_tax").alias("spent")).withColumn("allocated", 0.05 * F.sum("spent").over(every))
    left = 1 - F.col("spent") / F.col("allocated")
    return s.select("part", F.round(left, 6).alias("unspent"), F.when(F.col("spent") == 0, "starved").when(left >= 0.9, "unspent").otherwise("spent").alias("state"), F.round(F.col("spent") / F.sum("spent").over(every), 6).alias("realised"))


@query("""select o_orderstatus as part, round(quantile_cont(o_totalprice, 0.1), 4) as p10, round(quantile_cont(o_totalprice, 0.9), 4) as p90, round(median(o_totalprice), 4) as middle,
  round(quantile_cont(o_totalprice, 0.75) - quantile_cont(o_totalprice, 0.25), 4) as iqr, min(o_totalprice) as low, max(o_totalprice) as high from orders group by 1""")
def tone_band(spark, d):
    q = F.percentile("o_totalprice", F.array(*[F.lit(p) for p in (0.1, 0.25, 0.5, 0.75, 0.9)]))
    got = table(spark, d, "orders").groupBy(F.col("o_orderstatus").alias("part")).agg(q.alias("q"), F.min("o_totalprice").alias("low"), F.max("o_totalprice").alias("high"))
    return got.select("part", F.round(F.col("q")[0], 4).alias("p10"), F.round(F.col("q")[4], 4).alias("p90"), F.round(F.col("q")[2], 4).alias("middle"), F.round(F.col("q")[3] - F.col("q")[1], 4).alias("iqr"), "low", "high")


@query("""with g as (select o_orderkey, abs(o_totalprice - lag(o_totalprice) over (partition by o_custkey order by o_orderkey)) as e, least(199, floor(o_totalprice / 500000 * 200))::bigint as bin from orders),
b as (select bin, avg(e) as e from g where e is not null group by bin)
select bin, round(sum(e) over (order by bin) / sum(e) over (), 8) as curve from b""")
def edge_transfer(spark, d):
    step = F.abs(F.col("o_totalprice") - F.lag("o_totalprice").over(Window.partitionBy("o_custkey").orderBy("o_orderkey")))
    g = table(spark, d, "orders").select(step.alias("e"), F.least(F.lit(199), F.floor(F.col("o_totalprice") / 500000 * 200)).alias("bin")).where("e is not null").groupBy("bin").agg(F.avg("e").alias("e"))
    every = Window.partitionBy()
    return g.select("bin", F.round(F.sum("e").over(every.orderBy("bin")) / F.sum("e").over(every), 8).alias("curve"))


@query("select floor(log10(o_totalprice))::bigint as decade, count(*) as candidates, count(*) filter (o_orderstatus = 'F') as admitted, min(o_totalprice) filter (o_orderstatus = 'F') as deepest from orders group by 1")
def depth_histogram(spark, d):
    return table(spark, d, "orders").groupBy(F.floor(F.log10("o_totalprice")).alias("decade")).agg(F.count("*").alias("candidates"), F.count_if(F.col("o_orderstatus") == "F").alias("admitted"), F.min(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))).alias("deepest"))


@query("select n_regionkey, sha256(string_agg(n_name || ':' || n_nationkey, ',' order by n_name)) as digest from nation group by 1")
def reference_digest(spark, d):
    names = F.sort_array(F.collect_list(F.struct("n_name", F.concat_ws(":", "n_name", F.col("n_nationkey").cast("string")).alias("t"))))
    return table(spark, d, "nation").groupBy("n_regionkey").agg(F.sha2(F.concat_ws(",", F.transform(names, lambda z: z["t"])), 256).alias("digest"))


@query("""select o_custkey, round(1.96 * sqrt(count(*) filter (o_orderstatus = 'F')) / count(*), 8) as half_width, abs(count(*) filter (o_orderstatus = 'F') - count(*) filter (o_orderstatus = 'O')) / count(*) > 1.96 * sqrt(count(*) filter (o_orderstatus = 'F')) / count(*) as resolved from orders group by 1""")
def sample_power(spark, d):
    f, o, n = F.count_if(F.col("o_orderstatus") == "F"), F.count_if(F.col("o_orderstatus") == "O"), F.count("*")
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.round(1.96 * F.sqrt(f) / n, 8).alias("half_width"), (F.abs(f - o) / n > 1.96 * F.sqrt(f) / n).alias("resolved"))


@query("""with f as (select *, o_orderstatus = 'F' as fresh, o_orderpriority = '1-URGENT' as urgent from orders),
r as (select *, (fresh and row_number() over (partition by fresh order by o_totalprice desc, o_orderkey) <= 10) or (urgent and row_number() over (partition by urgent order by o_totalprice desc, o_orderkey) <= 5) as reserved from f)
select o_orderkey, place::integer as place from (select *, row_number() over (order by reserved desc, o_totalprice desc, o_orderkey) as place from r) where place <= 64""")
def batch_pop(spark, d):
    return W.batch_pop(table(spark, d, "orders"), "o_totalprice", "o_orderkey", {"o_orderstatus = 'F'": 10, "o_orderpriority = '1-URGENT'": 5}, 64).select("o_orderkey", "place")


@query("select c_custkey, c_nationkey from customer where c_custkey not in (select o_custkey from orders group by o_custkey having count(*) >= 12)")
def capped_eviction(spark, d):
    nodes = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    return W.evicted(nodes, table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", 12)


@query()
def greedy_spacing(spark, d):
    k = F.col("o_orderkey")
    pts = table(spark, d, "orders").select(k.alias("id"), F.concat_ws("|", "o_orderstatus", "o_orderpriority").alias("twin"), (k * 7919 % 10007 / 10007).alias("x"), (k * 104729 % 9973 / 9973).alias("y"))
    return D.kept_apart(pts, "twin", "id", 0.032, Scratch(spark, "spacing"))


@query("""with c as (select *, ('0x' || substr(md5('5|' || user_id || '|' || event_type || '|' || event_id), 1, 12))::bigint / 281474976710656.0::double as coin from events)
select user_id, event_type, min(event_id) as event_id from c where coin < 0.25 group by 1, 2""")
def probe_governor(spark, d):
    rolls = table(spark, d, "events").select("user_id", "event_type", "event_id")
    return W.governed(rolls, ["user_id", "event_type"], "event_id", 0.25, 5)


@query("""with n as (select o_custkey, count(*) as density from orders group by 1)
select o_orderkey, round(o_totalprice / 1000 + (1 / (1 + 0.5 * density) - 1) * o_totalprice / 2000, 8) as priority from orders join n using (o_custkey)""")
def memory_discount(spark, d):
    o = table(spark, d, "orders")
    n = o.groupBy("o_custkey").agg(F.count("*").alias("density"))
    p = W.memory_discount(F.col("o_totalprice") / 1000, F.col("o_totalprice") / 2000, F.col("density"), 0.5)
    return o.join(n, "o_custkey").select("o_orderkey", F.round(p, 8).alias("priority"))


@query("""with s as (select lang, share from (select lang, count(*) / sum(count(*)) over () as share from documents group by 1)), q as (select doc_id, lang, row_number() over (order by doc_id) as i from documents),
g as (select s.lang, i, sum((q.lang = s.lang)::int) over (partition by s.lang order by i) as n, share from q, s)
select lang, round(max(abs(n - i * share)), 6) as deviation from g group by lang""")
def prefix_deviation(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang")
    shares = docs.groupBy("lang").count().select("lang", (F.col("count") / F.sum("count").over(Window.partitionBy())).alias("share"))
    return W.prefix_deviation(docs.withColumnRenamed("lang", "got").select("doc_id", F.col("got").alias("lang")), "doc_id", "lang", shares).withColumn("deviation", F.round("deviation", 6))


@query("""with b as (select o_orderkey, 1 + (o_totalprice > 100000)::int + (o_totalprice > 200000)::int as tier, 1 / (1 + exp(-(o_totalprice - 100000) / 50000)) as p2, 1 / (1 + exp(-(o_totalprice - 200000) / 50000)) as p3 from orders)
select round((avg(-case when tier >= 2 then ln(p2) else ln(1 - p2) end) + avg(-case when tier >= 3 then ln(p3) else ln(1 - p3) end) filter (tier >= 2)) / 2, 8) as loss from b""")
def conditional_tier_loss(spark, d):
    x = F.col("o_totalprice")
    tier = 1 + (x > 100000).cast("int") + (x > 200000).cast("int")
    p2, p3 = 1 / (1 + F.exp(-(x - 100000) / 50000)), 1 / (1 + F.exp(-(x - 200000) / 50000))
    a = F.avg(-F.when(tier >= 2, F.ln(p2)).otherwise(F.ln(1 - p2)))
    b = F.avg(F.when(tier >= 2, -F.when(tier >= 3, F.ln(p3)).otherwise(F.ln(1 - p3))))
    return table(spark, d, "orders").agg(F.round((a + b) / 2, 8).alias("loss"))


@query("""select o_orderkey, '["' || o_orderstatus || '","' || o_orderpriority || '",' || o_custkey || ']' as key, round(fmod(pow(least(greatest(o_totalprice / 500000, 0), 1), 1.5) * 3, 1) + 0.25, 8) as placed from orders""")
def keys_and_placement(spark, d):
    key = F.concat(F.lit('["'), F.col("o_orderstatus"), F.lit('","'), F.col("o_orderpriority"), F.lit('",'), F.col("o_custkey").cast("string"), F.lit("]"))
    x = F.least(F.greatest(F.col("o_totalprice") / 500000, F.lit(0.0)), F.lit(1.0))
    return table(spark, d, "orders").select("o_orderkey", key.alias("key"), F.round(F.pmod(F.pow(x, F.lit(1.5)) * 3, F.lit(1.0)) + 0.25, 8).alias("placed"))


@query("select conv_id as doc_id, string_agg(turn || ':' || role, ',' order by turn) as slots from conversations group by 1")
def slot_grouping(spark, d):
    s = F.array_sort(F.collect_list(F.struct("turn", "role")))
    return table(spark, d, "conversations").groupBy(F.col("conv_id").alias("doc_id")).agg(F.array_join(F.transform(s, lambda z: F.concat_ws(":", z["turn"].cast("string"), z["role"])), ",").alias("slots"))
