"""Queries on census, prices and shares."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import supply as S
from tessera.sources.tables import table

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


_CLASS = "case when quality = 1 and toxic = 0 then 4 when quality = 1 then 3 when toxic = 1 then 1 else 2 end"
_CENSUS = f"""
with r as (select lang, {_CLASS} as cls from labels join documents using (doc_id)),
c as (select lang, count(*) filter (cls = 1) as n1, count(*) filter (cls = 2) as n2, count(*) filter (cls = 3) as n3, count(*) filter (cls = 4) as n4,
  sum(case cls when 4 then 1.0 when 3 then 0.1 else 0 end)::double as currency from r group by lang)"""


def classed(spark, d):
    return table(spark, d, "labels").join(table(spark, d, "documents").select("doc_id", "lang", "source"), "doc_id").withColumn("cls", F.expr(_CLASS))


@query(_CENSUS + " select lang, coalesce(n1,0) as n1, coalesce(n2,0) as n2, coalesce(n3,0) as n3, coalesce(n4,0) as n4, round(coalesce(currency,0),6) as currency from (select distinct lang from documents) left join c using (lang)")
def census_currency(spark, d):
    out = S.census(classed(spark, d), table(spark, d, "documents"), "lang", "cls")
    return out.withColumn("currency", F.round("currency", 6))


@query(_CENSUS + """, m as (select lang, sum(case when n_chars > 3000 then 1.0 when n_chars > 1500 then 0.1 else 0 end)::double as machine from documents where doc_id not in (select doc_id from labels) group by lang)
select lang, round(currency + 0.2 * machine, 6) as stock from c join m using (lang)""")
def combined_census(spark, d):
    labelled = S.census(classed(spark, d), table(spark, d, "documents"), "lang", "cls").select("lang", "currency")
    rest = table(spark, d, "documents").join(table(spark, d, "labels").select("doc_id"), "doc_id", "left_anti")
    rest = rest.withColumn("cls", F.when(F.col("n_chars") > 3000, 4).when(F.col("n_chars") > 1500, 3))
    machine = rest.groupBy("lang").agg(F.sum(S.currency(F.col("cls"))).alias("machine"))
    return labelled.join(machine, "lang").select("lang", F.round(F.col("currency") + S.MACHINE * F.col("machine"), 6).alias("stock"))


@query(_CENSUS + """, s as (select lang, currency as stock, length(lang) + ascii(lang) % 3 as ratio from c)
select lang, round(stock, 6) as stock, round(max(stock) over () * ratio / max(ratio) over (), 6) as target,
  round(greatest(0, max(stock) over () * ratio / max(ratio) over () - stock), 6) as deficit from s""")
def target_deficit(spark, d):
    stock = S.census(classed(spark, d), table(spark, d, "documents"), "lang", "cls").select("lang", F.col("currency").alias("stock"))
    ratio = stock.select("lang", (F.length("lang") + F.ascii("lang") % 3).alias("ratio"))
    return S.deficits(stock, ratio, "lang").select("lang", *[F.round(c, 6).alias(c) for c in ("stock", "target", "deficit")])


_SPENT = "select l_returnflag || l_linestatus as part, round(sum(l_tax), 4) as minutes, round(sum(case when l_discount > 0.09 then l_discount else 0 end), 4) as units from lineitem group by 1"


def spent(spark, d):
    l = table(spark, d, "lineitem")
    return l.groupBy(F.concat("l_returnflag", "l_linestatus").alias("part")).agg(F.round(F.sum("l_tax"), 4).alias("minutes"), F.round(F.sum(F.when(F.col("l_discount") > 0.09, F.col("l_discount")).otherwise(0)), 4).alias("units"))


@query(f"select part, case when units < 1 then 3.0 else round_even(minutes / units, 3) end as price, units < 1 as defaulted from ({_SPENT})")
def price_pool(spark, d):
    return S.measured_prices(spent(spark, d), "part")


@query(f"""with p as (select part, case when units < 1 then 3.0 else round_even(minutes / units, 3) end as price, units < 1 as defaulted from ({_SPENT}))
select part, round(case when defaulted then price else exp(0.9 * ln(price) + 0.1 * ln((select median(price) from p where not defaulted))) end, 8) as price from p""")
def price_shrink(spark, d):
    return S.shrunk(S.measured_prices(spent(spark, d), "part"), "part").withColumn("price", F.round("price", 8))


@query("""
with m as (select l_returnflag as part, date_part('year', l_shipdate) * 100 + date_part('month', l_shipdate) as step, round(avg(l_extendedprice), 6) as v from lineitem group by 1, 2),
f as (select part, list(v order by step) as s from m group by part)
select part, len(s)::integer as steps, round(list_reduce(s, lambda a, x: a * 0.85 + x * 0.15), 4) as ema from f""")
def price_ema(spark, d):
    steps = table(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("part"), (F.year("l_shipdate") * 100 + F.month("l_shipdate")).alias("step")).agg(F.round(F.avg("l_extendedprice"), 6).alias("v"))
    return S.ema(steps, "part", "step", "v").select("part", "steps", F.round("ema", 4).alias("ema"))


@query("select event_type, case when count(*) filter (user_id % 3 = 0) < 5 then 0.0 else round(quantile_cont(value, 0.1) filter (user_id % 3 = 0), 8) end as cut, count(*) filter (user_id % 3 = 0) as good from events group by 1")
def quantile_cut(spark, d):
    good = F.col("user_id") % 3 == 0
    cut = F.when(F.count_if(good) < 5, 0.0).otherwise(F.round(F.percentile(F.when(good, F.col("value")), F.lit(0.1)), 8))
    return table(spark, d, "events").groupBy("event_type").agg(cut.alias("cut"), F.count_if(good).alias("good"))


def nation_revenue(spark, d):
    n, c, o = table(spark, d, "nation"), table(spark, d, "customer"), table(spark, d, "orders")
    weight = F.floor(F.sum(F.pow(F.col("o_totalprice") / 1000, 2))).cast("long") * F.max(F.col("n_nationkey") % 4)
    return o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_name").agg(weight.cast("double").alias("weight"))


_REV = "select n_name, (floor(sum(pow(o_totalprice / 1000, 2)))::bigint * max(n_nationkey % 4))::double as weight from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by n_name"


@query(f"""
with w as ({_REV}), e as (select *, n_name like 'I%' as out from w), s as (select *, row_number() over (partition by out order by weight, n_name) - 1 as i, count(*) over (partition by out) as n, sum(weight) over (partition by out order by weight, n_name rows between current row and unbounded following) as rest, sum(weight) over (partition by out) as total from e),
t as (select *, case when rest > 0 then (1 - i * 0.01) / rest end as scale from s), k as (select min(i) as cut from t where not out and scale * weight >= 0.01 - 1e-12)
select n_name, weight, round(case when out then 0.0 when total <= 0 or n * 0.01 >= 1 then 1.0 / n when i < cut then 0.01 else (select scale from t, k where i = cut and not out) * weight end, 9) as share, case when out then false when n * 0.01 >= 1 then true when total <= 0 then 1.0 / n < 0.01 else i < cut end as floored from t, k""")
def waterfill_share(spark, d):
    out = S.water_fill(nation_revenue(spark, d), "n_name", "weight", 0.01, F.col("n_name").startswith("I"))
    return out.withColumn("share", F.round("share", 9))


def weights_of(spark, d) -> dict[str, float]:
    return {r["n_name"]: r["weight"] for r in nation_revenue(spark, d).orderBy("n_name").collect()}  # one row per nation


#: Picks one after the other; of the cells furthest behind, by (gap, weight, name), the last in order.
_SEQUENCE = """{name}(place, taken, pick) as (select 0, list_transform(names, lambda n: 0), null::varchar from {cells} union all
 select place + 1, list_transform(range(1, len(names) + 1), lambda i: taken[i] + (i = best.i)::integer), best.n from (select {name}.place, {name}.taken, names, list_last(list_sort(list_transform(list_filter(range(1, len(names) + 1), lambda i: ws[i] > 0 and taken[i] < caps[i]), lambda i: {{g: (place + 1) * ws[i] / total - taken[i], w: ws[i], n: names[i], i: i}}))) as best from {name}, {cells} where place < {n}) where best is not null)"""


@query(f"""with recursive w as ({_REV}), cells as (select list(n_name order by n_name) as names, list(weight order by n_name) as ws, sum(weight) as total, list(case when n_name = 'BRAZIL' then 3 when n_name like 'C%' then 0 else 9 end order by n_name) as caps from w), {_SEQUENCE.format(name='seq', cells='cells', n=64)}
select place::integer as place, pick as n_name from seq where place > 0""")
def largest_deficit_slots(spark, d):
    weights = weights_of(spark, d)
    picks = S.largest_deficit(weights, 64, {k: 3 if k == "BRAZIL" else 9 for k in weights if not k.startswith("C")})
    return spark.createDataFrame([(i + 1, p) for i, p in enumerate(picks)], "place int, n_name string")


@query()
def guaranteed_slots(spark, d):
    weights = weights_of(spark, d)
    got = S.guaranteed_slots(weights, 12, None, list(weights)[:6])
    return spark.createDataFrame(sorted(got.items()), "n_name string, slots int")


@query(f"""with w as ({_REV}), t as (select n_name, weight, weight / sum(weight) over () as intended, round(weight) % 7 as spent from w) select n_name, round(intended - spent / sum(spent) over (), 9) as gap from t where n_name not like 'U%'""")
def share_gap(spark, d):
    weights = weights_of(spark, d)
    total = sum(weights.values())
    gaps = S.share_gaps({k: v / total for k, v in weights.items()}, {k: v % 7 for k, v in weights.items()}, [k for k in weights if not k.startswith("U")])
    return spark.createDataFrame([(k, round(v, 9)) for k, v in gaps.items()], "n_name string, gap double")


@query()
def batch_slots(spark, d):
    weights = weights_of(spark, d)
    total = sum(weights.values())
    slots, source = S.batch_slots({k: v / total for k, v in weights.items()}, {k: v % 7 for k, v in weights.items()}, {k: int(v) % 5 for k, v in weights.items()}, 8, [k for k in weights if k < "E"], ["KENYA"], {k: 1 + v % 3 for k, v in weights.items()})
    return spark.createDataFrame([(k, v, source) for k, v in slots.items()], "n_name string, slots int, source string")


@query()
def attempt_plan(spark, d):
    weights = {k: max(v, 1.0) for k, v in weights_of(spark, d).items()}
    plan = S.attempt_cells({k: int(v) % 9 for k, v in weights.items()}, weights, 10, 0.35, 30, [k for k in weights if k < "F"])
    return spark.createDataFrame([(i + 1, *cell) for i, cell in enumerate(plan)], "place int, head string, n_name string, rank int")


@query("select max(v) / min(v) as ratio from (select sum(l_tax) as v from lineitem group by l_returnflag)")
def spread_ratio(spark, d):
    return S.spread_ratio(table(spark, d, "lineitem").groupBy("l_returnflag").agg(F.sum("l_tax").alias("v")), "v")


@query("select p_partkey, greatest(least(p_retailprice / 100, 12.0), 0.75) as price, round(1 - pow(0.85, p_size), 10) as weight from part")
def price_clamp(spark, d):
    return table(spark, d, "part").select("p_partkey", S.clamped_price(F.col("p_retailprice") / 100, F.lit(3.0)).alias("price"), F.round(S.sample_weight(F.col("p_size")), 10).alias("weight"))


@query("""with m as (select l_returnflag as part, date_part('year', l_shipdate) * 100 + date_part('month', l_shipdate) as step, round(sum(l_tax), 6) as m, round(sum(l_discount), 6) as u from lineitem group by 1, 2), f as (select part, list(m order by step) as ms, list(u order by step) as us from m group by part)
select part, len(ms)::integer as steps, round(list_reduce(ms, lambda a, x: a * 0.85 + x * 0.15, 0.0) / greatest(list_reduce(us, lambda a, x: a * 0.85 + x * 0.15, 0.0), 1e-6), 6) as price from f""")
def price_ema_ratio(spark, d):
    steps = table(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("part"), (F.year("l_shipdate") * 100 + F.month("l_shipdate")).alias("step")).agg(F.round(F.sum("l_tax"), 6).alias("m"), F.round(F.sum("l_discount"), 6).alias("u"))
    return S.ema_ratio(steps, "part", "step", "m", "u").select("part", "steps", F.round("price", 6).alias("price"))


@query("""select coalesce(r.k, m.k) as part, case when m.k is null then 'missing' when r.k is null then 'unregistered' else 'not_positive' end as why from (select distinct n_nationkey as k from nation where n_nationkey < 20) r full join (select n_nationkey as k, n_nationkey % 6 as ratio from nation where n_nationkey % 5 <> 1) m using (k) where m.k is null or r.k is null or ratio = 0""")
def mix_completeness(spark, d):
    n = table(spark, d, "nation")
    mix = n.where("n_nationkey % 5 <> 1").select(F.col("n_nationkey").alias("part"), (F.col("n_nationkey") % 6).alias("ratio"))
    return S.incomplete(mix, n.where("n_nationkey < 20").select(F.col("n_nationkey").alias("part")), "part", "ratio")


@query("""with s as (select event_type as part, sum(value) as minutes, count(*) as batches, count(distinct user_id) as admitted from events group by 1), i as (select n_nationkey, n_name from nation), p as (select part, 1.0 / count(*) over () as intent from (select distinct event_type as part from events union select 'none'))
select p.part, intent, round(coalesce(minutes / sum(minutes) over (), 0), 9) as minutes_share, round(coalesce(batches / sum(batches) over (), 0), 9) as batches_share, round(coalesce(admitted / sum(admitted) over (), 0), 9) as admitted_share, round(intent - coalesce(minutes / sum(minutes) over (), 0), 9) as gap from p left join s using (part)""")
def realised_mix(spark, d):
    e = table(spark, d, "events").select(F.col("event_type").alias("part"), F.col("value").alias("minutes"), "user_id")
    steps = e.groupBy("part").agg(F.sum("minutes").alias("minutes"), F.count("*").alias("batches"), F.count_distinct("user_id").alias("admitted"))
    names = steps.select("part").unionByName(spark.createDataFrame([("none",)], "part string"))
    total = names.agg(F.count("*").alias("n"))
    intents = names.crossJoin(F.broadcast(total)).select("part", (1.0 / F.col("n")).alias("intent"))  # one row
    out = S.realised_mix(steps, "part", ["minutes", "batches", "admitted"], intents)
    return out.select("part", "intent", *[F.round(c, 9).alias(c) for c in ("minutes_share", "batches_share", "admitted_share", "gap")])


@query("""select l_returnflag as part, sum(case when l_linestatus = 'F' then l_quantity else 0 end) as floor_minutes, sum(case when l_linestatus <> 'F' then l_quantity else 0 end) as deficit_minutes, round(sum(case when l_linestatus = 'F' then l_quantity else 0 end) / sum(l_quantity), 9) as floor_share from lineitem group by 1""")
def floor_versus_deficit(spark, d):
    got = table(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("part")).agg(F.sum(F.when(F.col("l_linestatus") == "F", F.col("l_quantity")).otherwise(0)).alias("floor_minutes"), F.sum(F.when(F.col("l_linestatus") != "F", F.col("l_quantity")).otherwise(0)).alias("deficit_minutes"))
    return got.withColumn("floor_share", F.round(F.col("floor_minutes") / (F.col("floor_minutes") + F.col("deficit_minutes")), 9))


@query("""
with s as (select c_nationkey as part, count(*) as cap from customer group by 1)
select part, cap, slots from (
  select part, cap, (select sum(case when t.cap <= lv then t.cap else 0 end) from s t) as x, lv,
    case when cap <= lv then cap else lv + case when row_number() over (partition by cap > lv order by part) <= 200 - tot then 1 else 0 end end as slots
  from s, (select max(l) as lv, max_by(f, l) as tot from (select l, (select sum(least(cap, l)) from s) as f from range(0, 1000) r(l)) where f <= 200))""")
def even_capped_slots(spark, d):
    caps = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("part")).agg(F.count("*").alias("cap"))
    return S.even_capped(caps, "part", "cap", 200)


@query("select event_type as part, count(*) as ratio, round(count(*) / sum(count(*)) over (), 10) as share from events group by 1")
def mix_shares(spark, d):
    mix = table(spark, d, "events").groupBy(F.col("event_type").alias("part")).agg(F.count("*").alias("ratio"))
    return S.mix_shares(mix, "part").withColumn("share", F.round("share", 10))


@query("""select l_returnflag as part, round(case when sum(l_tax) > 0 then sum(l_discount * l_tax) / sum(l_tax) else avg(l_discount) end, 8) as intent from lineitem group by 1""")
def effective_intent(spark, d):
    rows = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("part"), F.col("l_discount").alias("intent"), F.col("l_tax").alias("minutes"))
    return S.effective_intent(rows, "part").withColumn("intent", F.round("intent", 8))


@query("""
with s as (select n_nationkey as part, coalesce(sum(s_acctbal), 0) as minutes, count(s_suppkey) filter (s_acctbal > 5000) as slots from nation left join supplier on s_nationkey = n_nationkey group by 1)
select part, round(case when slots > 0 then minutes / slots when sum(slots) over () > 0 then sum(minutes) over () / sum(slots) over () else 1 end, 6) as per_slot from s""")
def minutes_per_slot(spark, d):
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("s_nationkey"))
    s = n.join(table(spark, d, "supplier"), "s_nationkey", "left").groupBy(F.col("s_nationkey").alias("part")).agg(F.coalesce(F.sum("s_acctbal"), F.lit(0.0)).alias("minutes"), F.count_if(F.col("s_acctbal") > 5000).alias("slots"))
    return S.minutes_per_slot(s, "part").withColumn("per_slot", F.round("per_slot", 6))


@query("""
with t as (select n_nationkey, n_regionkey, (select count(*) from customer where c_nationkey = n_nationkey and c_acctbal > 5000) as queued from nation),
f as (select n_regionkey, sum(n_nationkey) filter (queued < 5) as folded from t group by 1)
select n_nationkey, case when queued < 5 then 0 else n_nationkey + case when n_nationkey = (select min(u.n_nationkey) from t u where u.n_regionkey = t.n_regionkey and u.queued >= 5) then coalesce(folded, 0) else 0 end end::bigint as intent
from t join f using (n_regionkey)""")
def intent_fold(spark, d):
    n, c = table(spark, d, "nation"), table(spark, d, "customer").where("c_acctbal > 5000").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("queued"))
    t = n.join(c, "n_nationkey", "left").withColumn("queued", F.coalesce("queued", F.lit(0)))
    f = t.groupBy("n_regionkey").agg(F.sum(F.when(F.col("queued") < 5, F.col("n_nationkey")).otherwise(0)).alias("folded"), F.min(F.when(F.col("queued") >= 5, F.col("n_nationkey"))).alias("parent"))
    own = F.col("n_nationkey") + F.when(F.col("n_nationkey") == F.col("parent"), F.col("folded")).otherwise(0)
    return t.join(f, "n_regionkey").select("n_nationkey", F.when(F.col("queued") < 5, 0).otherwise(own).cast("long").alias("intent"))


@query("select l_returnflag as part, count(*) as found, count(*) filter (l_discount > 0.02) as scored, count(*) filter (l_discount > 0.05) as passing, count(*) filter (l_discount > 0.08) as good, (count(*) filter (l_discount > 0.05)) // 4 as cap from lineitem group by 1")
def funnel(spark, d):
    got = table(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("part")).agg(F.count("*").alias("found"), *[F.count_if(F.col("l_discount") > x).alias(n) for n, x in (("scored", 0.02), ("passing", 0.05), ("good", 0.08))])
    return got.withColumn("cap", S.thin_cap(F.col("passing")))
