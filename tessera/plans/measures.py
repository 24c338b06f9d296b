"""Queries on evaluation statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import measure as M
from tessera.sources.tables import table

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


#: A score with ties, and a second one that disagrees with it here and there.
_SCORED = "select doc_id, lang, source, quality, toxic, (n_chars % 101) / 100.0::double as score, ((n_chars * 7 + doc_id) % 89) / 88.0::double as other from labels join documents using (doc_id)"


def scored(spark, d):
    both = table(spark, d, "labels").join(table(spark, d, "documents").drop("text"), "doc_id")
    return both.select("doc_id", "lang", "source", "quality", "toxic", (F.col("n_chars") % 101 / 100).alias("score"), ((F.col("n_chars") * 7 + F.col("doc_id")) % 89 / 88).alias("other"))


def _auc(by: str = "") -> str:
    keys = f"{by}, " if by else ""
    part = f"partition by {by} " if by else ""
    return f"""
with s as ({_SCORED}), g as (select {keys}score, count(*) filter (quality = 1) as p, count(*) filter (quality = 0) as q from s group by {keys}score),
b as (select *, coalesce(sum(q) over ({part}order by score rows between unbounded preceding and 1 preceding), 0) as below from g)
select {keys}sum(p)::bigint as positives, sum(q)::bigint as negatives, case when sum(p) > 0 and sum(q) > 0 then round(sum(p * (below + q / 2)) / (sum(p) * sum(q)), 9) end as auc from b {'group by ' + by if by else ''}"""


@query(_auc())
def auc(spark, d):
    return M.auc(scored(spark, d), "score", "quality").withColumn("auc", F.round("auc", 9))


@query(f"select lang, positives, negatives, auc, case when positives < 10 then 'NOT_MEASURABLE' else 'MEASURED' end as state from ({_auc('lang')})")
def auc_by_partition(spark, d):
    got = M.auc(scored(spark, d), "score", "quality", ["lang"]).withColumn("auc", F.round("auc", 9))
    return got.withColumn("state", F.when(F.col("positives") < 10, "NOT_MEASURABLE").otherwise("MEASURED"))


@query(f"""with s as ({_SCORED}), r as (select *, row_number() over (order by score desc, doc_id) as i from s), h as (select *, sum(quality) over (order by i) as h from r)
select round(avg(h / i) filter (quality = 1), 9) as average_precision from h""")
def average_precision(spark, d):
    return M.average_precision(scored(spark, d), "score", "quality", "doc_id").withColumn("average_precision", F.round("average_precision", 9))


@query(f"""with s as ({_SCORED}), c as (select k, greatest(least(score * k, 1 - 1e-7), 1e-7) as p, case when quality + toxic >= k then 1 else 0 end as t from s, (values (1), (2)) v(k))
select k, round(avg(-(t * ln(p) + (1 - t) * ln(1 - p))), 8) as loss, count(*) filter (t = 1) as positives from c group by k""")
def cutpoint_log_loss(spark, d):
    s = scored(spark, d).withColumn("k", F.explode(F.array(F.lit(1), F.lit(2))))
    t = F.when(F.col("quality") + F.col("toxic") >= F.col("k"), 1).otherwise(0)
    return s.withColumn("t", t).groupBy("k").agg(F.round(F.avg(M.log_loss(F.col("score") * F.col("k"), F.col("t"))), 8).alias("loss"), F.count_if(F.col("t") == 1).alias("positives"))


@query(f"""with s as ({_SCORED}), r as (select lang, rank() over (partition by lang order by score) + (count(*) over (partition by lang, score) - 1) / 2 as a, rank() over (partition by lang order by other) + (count(*) over (partition by lang, other) - 1) / 2 as b from s)
select lang, round(corr(a, b), 8) as rho from r group by lang""")
def spearman(spark, d):
    return M.spearman(scored(spark, d), "score", "other", ["lang"]).withColumn("rho", F.round("rho", 8))


@query("""with s as (select o_custkey, o_orderkey, o_totalprice as x, o_orderkey % 97 as y from orders)
select a.o_custkey, count(*) filter (sign(a.x - b.x) * sign(a.y - b.y) < 0) as discordant, any_value(c.n)::integer as n
from s a left join s b on a.o_custkey = b.o_custkey and a.o_orderkey < b.o_orderkey join (select o_custkey, count(*) as n from s group by 1) c on a.o_custkey = c.o_custkey group by 1""")
def discordant_pairs(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", F.col("o_totalprice").alias("x"), (F.col("o_orderkey") % 97).alias("y"))
    return M.discordant(o, "o_custkey", "o_orderkey", "x", "y").withColumn("discordant", F.col("discordant").cast("long"))


@query(f"with s as ({_SCORED}) select lang, count(*) filter ((score >= 0.385) <> (other >= 0.385)) as flips, count(*) filter (score >= 0.385 and other < 0.385) as lost, count(*) filter (score < 0.385 and other >= 0.385) as gained, count(*) as n from s group by lang")
def gate_flips(spark, d):
    return M.flips(scored(spark, d), "score", "other", 0.385, ["lang"])


@query(f"""with s as ({_SCORED}), k as (select count(*) filter (score >= 0.385) as k from s), r as (select other, row_number() over (order by other desc) as i from s)
select k, round(other, 9) as crossing, round(floor(other / 0.005 + 1e-9) * 0.005, 9) as cut from r, k where i = k""")
def volume_match(spark, d):
    return M.volume_match(scored(spark, d), "score", "other", 0.385).select("k", F.round("crossing", 9).alias("crossing"), F.round("cut", 9).alias("cut"))


@query(f"with s as ({_SCORED}) select lang, round(avg(score), 9) as predicted, round(avg(quality), 9) as observed, abs(avg(score) / avg(quality) - 1) <= 0.25 as within from s group by lang")
def calibration(spark, d):
    return scored(spark, d).groupBy("lang").agg(F.round(F.avg("score"), 9).alias("predicted"), F.round(F.avg("quality"), 9).alias("observed"), (F.abs(F.avg("score") / F.avg("quality") - 1) <= 0.25).alias("within"))


@query("select k as cls, count(doc_id) as n from (values (0), (1), (2), (3)) v(k) left join (select doc_id, quality + toxic as s from labels) on s = k group by k")
def histogram(spark, d):
    keys = spark.createDataFrame([(k,) for k in range(4)], "cls int")
    got = table(spark, d, "labels").groupBy((F.col("quality") + F.col("toxic")).alias("cls")).agg(F.count("*").alias("n"))
    return keys.join(got, "cls", "left").select("cls", F.coalesce("n", F.lit(0)).alias("n"))


@query()
def cluster_bootstrap(spark, d):
    s = scored(spark, d).withColumn("delta", F.col("score") - F.col("other"))
    got = M.cluster_bootstrap(s, "source", "delta", 2000)
    return got.withColumn("verdict", M.verdict(F.col("low"), F.col("high")))


_SETS = "select o_custkey as k, list(x order by o_orderkey) as a, list(y order by o_orderkey) as b from (select *, o_totalprice as x, (o_orderkey * 37 % 101)::double as y from orders) group by 1"


@query(f"select k, round(list_max(b) - b[list_position(a, list_max(a))], 6) as regret, list_position(a, list_max(a)) = list_position(b, list_max(b)) as top_pick, round(list_max(b) - list_min(b), 6) as spread from ({_SETS})")
def set_regret(spark, d):
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("k"), "o_orderkey", F.col("o_totalprice").alias("x"), (F.col("o_orderkey") * 37 % 101).cast("double").alias("y"))
    return M.regret(o, "k", "o_orderkey", "x", "y").select("k", F.round("regret", 6).alias("regret"), "top_pick", F.round("spread", 6).alias("spread"))


@query("select o_orderkey, round(o_totalprice - avg(o_totalprice) over (partition by o_custkey), 4) as centred from orders")
def set_centring(spark, d):
    from pyspark.sql import Window

    return table(spark, d, "orders").select("o_orderkey", F.round(F.col("o_totalprice") - F.avg("o_totalprice").over(Window.partitionBy("o_custkey")), 4).alias("centred"))


@query("select round(median(s) / 2, 6) as temperature from (select stddev_pop(o_totalprice) as s from orders group by o_custkey)")
def temperature(spark, d):
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.stddev_pop("o_totalprice").alias("s")).agg(F.round(F.median("s") / 2, 6).alias("temperature"))


@query("""with p as (select o_custkey as k, list(o_totalprice / 50000 order by o_orderkey) as x, list((o_orderkey % 13) / 13.0::double order by o_orderkey) as y from orders group by 1),
z as (select k, list_transform(x, lambda v: exp(v - list_max(x))) as ex, list_transform(y, lambda v: exp(v - list_max(y))) as ey from p),
n as (select k, list_transform(ex, lambda v: v / list_sum(ex)) as px, list_transform(ey, lambda v: v / list_sum(ey)) as py from z)
select k, round(list_sum(list_transform(list_zip(px, py), lambda t: t[1] * ln(t[1] / t[2]))), 8) as kl from n""")
def softmax_kl(spark, d):
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("k"), "o_orderkey", (F.col("o_totalprice") / 50000).alias("x"), (F.col("o_orderkey") % 13 / 13).alias("y"))
    p = o.groupBy("k").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "x", "y"))).alias("s"))
    soft = lambda c: F.transform("s", lambda z: F.exp(z[c] - F.array_max(F.transform("s", lambda w: w[c]))))
    p = p.withColumn("ex", soft("x")).withColumn("ey", soft("y"))
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, v: a + v)
    p = p.withColumn("tx", total("ex")).withColumn("ty", total("ey"))
    kl = F.aggregate(F.zip_with("ex", "ey", lambda a, b: a / F.col("tx") * F.ln(a / F.col("tx") / (b / F.col("ty")))), F.lit(0.0), lambda t, v: t + v)
    return p.select("k", F.round(kl, 8).alias("kl"))
