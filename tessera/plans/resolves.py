"""Queries on resolving stores."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import resolve as R
from tessera.sources.tables import table

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


@query("""
select user_id, event_type, event_id, value, n - 1 as superseded from (
  select *, row_number() over (partition by user_id, event_type order by ts desc, event_id desc) as i,
    count(*) over (partition by user_id, event_type) as n from events) where i = 1""")
def resolve_latest(spark, d):
    rows = table(spark, d, "events").select("user_id", "event_type", "ts", "event_id", "value")
    return R.latest(rows, ["user_id", "event_type"], [F.col("ts"), F.col("event_id")]).drop("ts")


@query("""
select source, count(*) as kept, sum(n - 1)::bigint as dropped from (
  select source, row_number() over (partition by md5(text) order by source, doc_id) as i, count(*) over (partition by md5(text)) as n from documents)
where i = 1 group by source""")
def union_first_writer(spark, d):
    rows = table(spark, d, "documents")
    kept = R.first_writer(rows.select("doc_id", "source", "text"), F.md5("text"), [F.col("source"), F.col("doc_id")])
    return kept.groupBy("source").agg(F.count("*").alias("kept"), F.sum(F.col("copies") - 1).alias("dropped"))


@query("select doc_id, lang, source from documents where doc_id not in (select doc_id from labels)")
def precedence_anti(spark, d):
    return R.without(table(spark, d, "documents").select("doc_id", "lang", "source"), table(spark, d, "labels"), ["doc_id"])


_SNAP = "select user_id, event_type, count(*) as n, round(sum(value), 2) as total from events where value > {m} group by 1, 2"


@query(f"""
with a as ({_SNAP.format(m=20)}), b as ({_SNAP.format(m=5)})
select b.user_id, b.event_type, case when a.user_id is null then 'fresh' when a.n = b.n then 'unchanged' else 'revised' end as change
from b left join a using (user_id, event_type)""")
def cdc_classify(spark, d):
    def snapshot(m):
        return table(spark, d, "events").where(f"value > {m}").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))

    return R.change_class(snapshot(20), snapshot(5), ["user_id", "event_type"], ["n"])


@query("""
with o as (select c_custkey, c_name, c_acctbal, c_mktsegment as note from customer where c_acctbal < 6000),
n as (select c_custkey, c_name, c_acctbal + 1 as c_acctbal, case when c_custkey % 2 = 0 then 'new' end as note from customer where c_acctbal > 0)
select c_custkey, coalesce(n.c_name, o.c_name) as c_name, coalesce(n.c_acctbal, o.c_acctbal) as c_acctbal, coalesce(n.note, o.note) as note
from o full join n using (c_custkey)""")
def upsert_carry(spark, d):
    c = table(spark, d, "customer")
    old = c.where("c_acctbal < 6000").select("c_custkey", "c_name", "c_acctbal", F.col("c_mktsegment").alias("note"))
    new = c.where("c_acctbal > 0").select("c_custkey", "c_name", (F.col("c_acctbal") + 1).alias("c_acctbal"), F.when(F.col("c_custkey") % 2 == 0, "new").alias("note"))
    return R.upsert(old, new, ["c_custkey"], ["note"])


@query("""
select s_suppkey, s_nationkey, s_acctbal from supplier where s_nationkey not in (select distinct s_nationkey from supplier where s_acctbal < 0)
union all select s_suppkey, s_nationkey, 0.0::double from supplier where s_acctbal < 0""")
def scoped_replace(spark, d):
    s = table(spark, d, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    return R.replace_scope(s, s.where("s_acctbal < 0").withColumn("s_acctbal", F.lit(0.0)), ["s_nationkey"])


@query("""
select event_type, max_by(value, event_id) as value, max(event_id) as event_id, max_by(user_id % 3 = 0, event_id) as eval_only
from events group by event_type""")
def registry_latest(spark, d):
    rows = table(spark, d, "events").select("event_type", "event_id", "value", (F.col("user_id") % 3 == 0).alias("eval_only"))
    return R.latest(rows, ["event_type"], [F.col("event_id")]).select("event_type", "value", "event_id", "eval_only")


@query("""
with reg as (select n_nationkey, n_regionkey = 1 as eval_only, n_regionkey % 2 = 0 as plain, n_regionkey = 2 as anchored from nation where n_regionkey <> 3)
select c_custkey, coalesce(eval_only or (plain and not anchored), false) as eligible from customer left join reg on c_nationkey = n_nationkey""")
def registry_eligible(spark, d):
    reg = table(spark, d, "nation").where("n_regionkey <> 3").select(F.col("n_nationkey").alias("c_nationkey"), (F.col("n_regionkey") == 1).alias("eval_only"), (F.col("n_regionkey") % 2 == 0).alias("plain"), (F.col("n_regionkey") == 2).alias("anchored"))
    rows = table(spark, d, "customer").join(reg, "c_nationkey", "left")
    return rows.select("c_custkey", F.coalesce(F.col("eval_only") | (F.col("plain") & ~F.col("anchored")), F.lit(False)).alias("eligible"))


@query("""
with a as (select distinct o_custkey as k from orders where o_orderstatus = 'F'), b as (select distinct o_custkey as k from orders where o_orderstatus = 'O')
select k as custkey, case when a.k is null then 'gained' when b.k is null then 'lost' else 'kept' end as state from a full join b using (k)""")
def compare_populations(spark, d):
    o = table(spark, d, "orders").select("o_orderstatus", F.col("o_custkey").alias("custkey"))
    return R.compared(o.where("o_orderstatus = 'F'"), o.where("o_orderstatus = 'O'"), ["custkey"])


@query("""
select l_orderkey, coalesce(min(case when l_quantity >= 25 then l_shipmode end), min(l_shipmode)) as owner, bool_and(l_quantity < 25) as eligible
from (select l_orderkey, l_quantity, l_returnflag || l_linestatus as l_shipmode from lineitem) group by l_orderkey""")
def owner_batch(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_quantity", F.concat("l_returnflag", "l_linestatus").alias("batch"))
    return R.owner(rows, "l_orderkey", "batch", F.col("l_quantity") < 25)


@query("""
select c_custkey, c_acctbal, c_acctbal >= 5000 as clears, coalesce(c_acctbal >= 5000, false) as acts,
  case when c_acctbal >= 0.5 * 5000 then case when c_acctbal >= 5000 then 4 else 3 end end as cls,
  floor(log10(greatest(abs(c_acctbal), 1)))::bigint as decade,
  case when c_acctbal < 0 then 0 when c_acctbal < 500 then 1 when c_acctbal < 2000 then 2 when c_acctbal < 5000 then 3 else 4 end as band from customer""")
def cuts_and_bands(spark, d):
    x = F.col("c_acctbal")
    band = F.when(x < 0, 0).when(x < 500, 1).when(x < 2000, 2).when(x < 5000, 3).otherwise(4)
    cls = F.when(x >= 2500, F.when(x >= 5000, 4).otherwise(3))
    return table(spark, d, "customer").select("c_custkey", "c_acctbal", (x >= 5000).alias("clears"), F.coalesce(x >= 5000, F.lit(False)).alias("acts"), cls.alias("cls"), F.floor(F.log10(F.greatest(F.abs(x), F.lit(1.0)))).alias("decade"), band.alias("band"))


@query("""
select o_orderkey, case when o_orderstatus = 'F' and o_totalprice > 1000 then 'killed' when o_orderstatus = 'F' then 'released' else 'passed_over' end as verdict,
  case when o_totalprice > 1000 then 'over' end as rejected from orders""")
def retroactive_rejection(spark, d):
    o = table(spark, d, "orders")
    block = o.where("o_totalprice > 1000").select("o_orderkey", F.lit("over").alias("rejected"))
    both = o.join(block, "o_orderkey", "left")
    verdict = F.when((F.col("o_orderstatus") == "F") & F.col("rejected").isNotNull(), "killed").when(F.col("o_orderstatus") == "F", "released").otherwise("passed_over")
    return both.select("o_orderkey", verdict.alias("verdict"), "rejected")


@query("""
select n_nationkey, n_regionkey, case when n_nationkey in (select c_nationkey from customer where c_acctbal > 9000) then 'eval' else 'train' end as side from nation""")
def eval_pins(spark, d):
    pins = table(spark, d, "customer").where("c_acctbal > 9000").select(F.col("c_nationkey").alias("n_nationkey")).distinct().withColumn("_pin", F.lit(True))
    return table(spark, d, "nation").join(pins, "n_nationkey", "left").select("n_nationkey", "n_regionkey", F.when(F.col("_pin"), "eval").otherwise("train").alias("side"))


@query("""
with a as (select l_orderkey as k, sum(l_quantity) as q from lineitem group by 1), b as (select l_orderkey as k, max(l_tax) as t from lineitem group by 1), c as (select l_orderkey as k, count(*) as n from lineitem group by 1)
select k, q, t, n from a join b using (k) join c using (k)""")
def paired_alignment(spark, d):
    rows = table(spark, d, "lineitem").withColumnRenamed("l_orderkey", "k").groupBy("k")
    return R.aligned(rows.agg(F.sum("l_quantity").alias("q")), [rows.agg(F.max("l_tax").alias("t")), rows.agg(F.count("*").alias("n"))], "k")


@query("""
with a as (select doc_id from documents where lang = 'en' union select doc_id from labels where quality = 1)
select doc_id from a except select doc_id from labels where toxic = 1""")
def carried_and_drawn(spark, d):
    a = table(spark, d, "documents").where("lang = 'en'").select("doc_id").union(table(spark, d, "labels").where("quality = 1").select("doc_id")).distinct()
    return a.exceptAll(table(spark, d, "labels").where("toxic = 1").select("doc_id").distinct())
