"""Queries on ranking, selection, draws and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import select as P
from tessera.sources.tables import table

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


#: A release over parts: brands are partitions, a brand's types are groups, the bar is a price that half of them clear.
_RELEASE = """
s as (select p_brand as part, 4 + (ascii(substr(p_brand, 7, 1)) % 3) as slots, case when count(*) % 2 = 0 then count(*) // 4 % 5 end as cap, count(*) % 3 = 0 as g from part group by 1),
b as (select *, g and slots >= 1 as owed, case when g and slots >= 1 then greatest(least(slots, coalesce(cap, slots)), 1) else least(slots, coalesce(cap, slots)) end as budget from s),
c as (select printf('%04d', p_partkey) as id, p_brand as part, coalesce('group#' || p_brand || p_size % 7, '') as grp, p_retailprice as score from part where p_partkey % 10 <> 3),
u as (select p_brand || p_size % 7 as k, count(*) % 2 as used from part where p_partkey % 10 = 3 group by 1),
r as (select c.*, slots, budget, owed, coalesce(used, 0) as used, score >= 950 as good, row_number() over (partition by part order by score desc, id) - 1 as rank from c join b using (part) left join u on grp = 'group#' || k),
n as (select *, used + sum(good::int) over (partition by part, grp order by score desc, id rows between unbounded preceding and current row) as gc from r),
o as (select *, good and gc <= 2 as ok from n), t as (select *, coalesce(sum(ok::int) over (partition by part order by score desc, id rows between unbounded preceding and 1 preceding), 0) as taken from o),
log as (select * from t where taken < budget)"""


def _release(spark, d):
    p = table(spark, d, "part").withColumn("grp", F.concat(F.col("p_brand"), (F.col("p_size") % 7).cast("string")))
    n = F.count("*")
    slots = p.groupBy(F.col("p_brand").alias("part")).agg((4 + F.ascii(F.substring(F.first("p_brand"), 7, 1)) % 3).alias("slots"), F.when(n % 2 == 0, F.floor(n / 4) % 5).alias("cap"), (n % 3 == 0).alias("guaranteed"))
    earlier = p.where("p_partkey % 10 = 3").groupBy(F.concat(F.lit("group#"), F.col("grp")).alias("group")).agg((n % 2).alias("n"))
    candidates = P.entries(p.where("p_partkey % 10 <> 3"), "p_partkey", "p_brand", "grp", "p_retailprice")
    return P.release(candidates, slots, bar=950.0, used=earlier), candidates, slots


@query(f"with {_RELEASE} select id, part, grp as \"group\", rank::integer as rank, score, ok as picked, case when not good then 'below_bar' when not ok then 'cluster_cap' end as skipped, case when ok then case when owed and taken = 0 then 'guarantee' else 'mix' end end as slot_source, case when ok then gc end::bigint as group_count from log")
def release_log(spark, d):
    return _release(spark, d)[0]


@query(f"with {_RELEASE} select id, part, score, (row_number() over (partition by part order by score desc, id))::integer as place from log where ok")
def topn_capped(spark, d):
    picks = _release(spark, d)[0].where("picked")
    return picks.select("id", "part", "score", P.best_first_by("part", "score", ["id"]).alias("place"))


@query(f"""with {_RELEASE}, f as (select part, count(*) filter (ok) as seated, count(*) filter (not good) as below_bar, count(*) filter (good and not ok) as cluster_cap from log group by 1), e as (select part, count(*) as eligible from c group by 1)
select part, slots::bigint as planned, budget::bigint as budget, coalesce(eligible, 0) as eligible, coalesce(seated, 0) as seated, coalesce(below_bar, 0) as below_bar, coalesce(cluster_cap, 0) as cluster_cap, greatest(slots - coalesce(seated, 0), 0)::bigint as unfilled,
  case when slots > coalesce(seated, 0) then case when coalesce(seated, 0) < budget then case when below_bar > 0 then 'below_bar' when cluster_cap > 0 then 'cluster_cap' else 'no_candidates' end else 'supply_cap' end end as reason
from b left join f using (part) left join e using (part) where slots > 0""")
def slot_fill_reason(spark, d):
    return P.fills(*_release(spark, d))


@query("""with r as (select p_partkey, p_brand, p_size % 3 as head, row_number() over (partition by p_brand, p_size % 3 order by p_retailprice desc, p_partkey) as rank from part)
select p_partkey, p_brand, head, rank::integer as rank, (row_number() over (order by rank, p_brand, head, p_partkey))::integer as place from r""")
def rank_interleave(spark, d):
    p = table(spark, d, "part").withColumn("head", F.col("p_size") % 3)
    return P.interleaved(p, "p_brand", "head", "p_retailprice", "p_partkey").select("p_partkey", "p_brand", "head", "rank", "place")


@query("""with t as (select doc_id, lang, source, row_number() over (partition by lang, source order by md5('7|' || doc_id), doc_id) as turn from documents),
p as (select *, row_number() over (order by turn, lang, source, doc_id) as place from t)
select doc_id, lang, source, place::integer as place from p where place <= 150""")
def stratified_draw(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "source")
    return P.stratified(docs, ["lang", "source"], "doc_id", 150, 7)


@query("""with g as (select source, count(*) as n, bool_and(n_chars > 20) as ok, bool_or(doc_id = 5) as pin from documents group by 1),
b as (select *, coalesce(sum(n) over (order by pin desc, md5('0|' || source), source rows between unbounded preceding and 1 preceding), 0) as before from g where pin or ok)
select g.source, g.n, case when b.source is not null and (b.pin or b.before < (select round_even(count(*) * 0.2, 0) from documents)) then 'eval' else 'train' end as side from g left join b using (source)""")
def group_split(spark, d):
    docs = table(spark, d, "documents").select("source", (F.col("n_chars") > 20).alias("ok"), (F.col("doc_id") == 5).alias("pin"))
    return P.group_split(docs, "source", "ok", "pin", 0.2, 0)


@query("""with w as (select doc_id, quality, 1 / sqrt(count(*) over (partition by quality)) / count(*) over (partition by source) * case when toxic = 1 then 0.5 else 1 end as w from labels join documents using (doc_id))
select doc_id, quality, round(w, 10) as weight from w""")
def sampling_weights(spark, d):
    rows = table(spark, d, "labels").join(table(spark, d, "documents").select("doc_id", "source"), "doc_id")
    return P.sampling_weights(rows, "quality", "source", F.col("toxic") == 1, 0.5).select("doc_id", "quality", F.round("weight", 10).alias("weight"))


@query("""with a as (select s_suppkey, 0 as channel, row_number() over (order by s_suppkey) - 1 as i from supplier where s_acctbal >= 0),
b as (select s_suppkey, 1 as channel, row_number() over (order by s_suppkey) - 1 as i from supplier where s_acctbal < 0),
u as (select *, case channel when 0 then (i // 2) * 3 + i % 2 else i * 3 + 2 end as turn from (select * from a union all select * from b))
select s_suppkey, channel, (row_number() over (order by turn, channel, i))::integer as place from u""")
def two_to_one(spark, d):
    s = table(spark, d, "supplier").select("s_suppkey", "s_acctbal")
    return P.two_to_one(s.where("s_acctbal >= 0").drop("s_acctbal"), s.where("s_acctbal < 0").drop("s_acctbal"), "s_suppkey")


@query("""with r as (select o_orderkey, o_orderpriority, row_number() over (partition by o_orderpriority order by o_totalprice desc, o_orderkey) as rank from orders)
select o_orderkey, o_orderpriority, rank::integer as rank, (row_number() over (order by rank, o_orderpriority, o_orderkey))::integer as place from r""")
def period_round_robin(spark, d):
    return P.period_round_robin(table(spark, d, "orders"), "o_orderpriority", "o_totalprice", "o_orderkey").select("o_orderkey", "o_orderpriority", "rank", "place")


@query("select o_custkey, o_orderkey, o_totalprice from (select *, row_number() over (partition by o_custkey order by o_totalprice, o_orderkey) as i, count(*) over (partition by o_custkey) as n from orders) where i = n // 2 + 1")
def middle_run(spark, d):
    return P.middle_run(table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], "o_totalprice", "o_orderkey")


@query("select o_custkey, list(o_orderkey order by o_totalprice, o_orderkey) as candidates, list(o_totalprice order by o_totalprice, o_orderkey) as score from orders group by 1")
def set_folding(spark, d):
    s = table(spark, d, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_totalprice", "o_orderkey"))).alias("s"))
    return s.select("o_custkey", F.transform("s", lambda z: z["o_orderkey"]).alias("candidates"), F.transform("s", lambda z: z["o_totalprice"]).alias("score"))


@query("select doc_id from documents order by md5('3|' || doc_id), doc_id limit 100")
def reservoir(spark, d):
    return table(spark, d, "documents").select("doc_id").orderBy(P.hashed(3, "doc_id"), "doc_id").limit(100)


@query("select user_id, count(*) as n, (count(*) filter (event_type = 'purchase')) as admitted from events group by 1 order by n desc, user_id limit 50")
def lineage_counts(spark, d):
    return table(spark, d, "events").groupBy("user_id").agg(F.count("*").alias("n"), F.count_if(F.col("event_type") == "purchase").alias("admitted")).orderBy(F.desc("n"), "user_id").limit(50)
