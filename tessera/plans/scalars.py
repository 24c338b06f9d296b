"""Queries on scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import scalars as S
from tessera.functions.places import canonical_decimal
from tessera.sources.tables import table

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


@query("""with x as (select event_id, [value / 100, value / 130, value / 200] as v from events where value is not null),
s as (select event_id, list_transform(v, lambda z: 1 / (1 + exp(-(z - 0.3)))) as p from x),
c as (select event_id, [p[1], p[1] * p[2], p[1] * p[2] * p[3]] as q from s)
select event_id, round(q[1] + q[2] + q[3], 8) as score, (len(list_filter(q, lambda z: z >= 0.5)) + 1)::integer as tier from c""")
def tier_decode(spark, d):
    v = F.array(*[F.col("value") / k for k in (100, 130, 200)])
    rows = table(spark, d, "events").where("value is not null").select("event_id", S.running_product(F.transform(v, lambda z: S.sigmoid(z - 0.3))).alias("q"))
    return rows.select("event_id", F.round(S.rank_score(F.col("q")), 8).alias("score"), S.decoded_tier(F.col("q")).alias("tier"))


@query("""select l_orderkey, l_linenumber, round(1 / (1 + 0.7 * l_quantity), 10) as discount,
  trunc(greatest(least(4000 * (1 + 0.3 * log2(3 / (l_tax + 1e-9))), 67000), 200))::bigint as cap from lineitem""")
def discount_and_cap(spark, d):
    rows = table(spark, d, "lineitem")
    return rows.select("l_orderkey", "l_linenumber", F.round(S.saturation_discount(F.col("l_quantity"), 0.7), 10).alias("discount"), S.iteration_cap(F.col("l_tax") + 1e-9).alias("cap"))


@query("""with x as (select l_orderkey, l_linenumber, l_discount * 10 as x, l_tax * 12 as y from lineitem)
select l_orderkey, l_linenumber, k as kind, round(case k when 'sqrt' then sqrt(least(x, 1)) when 'log' then ln(1 + least(x, 1)) / ln(2) when 'smoothstep' then least(x, 1) * least(x, 1) * (3 - 2 * least(x, 1)) else least(x, 1) end, 8) as curve,
  round(case k when 'multiply' then x * y when 'screen' then 1 - (1 - x) * (1 - y) when 'overlay' then case when x < 0.5 then 2 * x * y else 1 - 2 * (1 - x) * (1 - y) end when 'min' then least(x, y) when 'add' then least(x + y, 1) else y end, 8) as blended,
  round(case k when 'soft' then case when x <= 0.8 then x else 0.8 + 0.2 * tanh((x - 0.8) / 0.2) end when 'reinhard' then x / (1 + x) when 'aces' then greatest(least(x * (2.51 * x + 0.03) / (x * (2.43 * x + 0.59) + 0.14), 1), 0) else x end, 8) as rolled
from x, (values ('linear'), ('sqrt'), ('log'), ('smoothstep'), ('multiply'), ('screen'), ('overlay'), ('min'), ('add'), ('soft'), ('reinhard'), ('aces')) v(k)""")
def colour_curves(spark, d):
    kinds = ["linear", "sqrt", "log", "smoothstep", "multiply", "screen", "overlay", "min", "add", "soft", "reinhard", "aces"]
    x = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_discount") * 10).alias("x"), (F.col("l_tax") * 12).alias("y"))
    x = x.withColumn("kind", F.explode(F.array(*[F.lit(k) for k in kinds])))
    k, a, b = F.col("kind"), F.col("x"), F.col("y")
    return x.select("l_orderkey", "l_linenumber", "kind", F.round(S.transfer(k, a), 8).alias("curve"), F.round(S.blend(k, a, b), 8).alias("blended"), F.round(S.rolloff(k, a), 8).alias("rolled"))


_LIN = "case when {0} <= 0.04045 then {0} / 12.92 else pow(({0} + 0.055) / 1.055, 2.4) end"


@query(f"""with c as (select p_partkey, (p_partkey % 256) / 255.0::double as r, (p_partkey * 7 % 256) / 255.0::double as g, (p_partkey * 13 % 256) / 255.0::double as b from part),
n as (select p_partkey, {_LIN.format('r')} as r, {_LIN.format('g')} as g, {_LIN.format('b')} as b from c),
m as (select p_partkey, cbrt(0.4122214708 * r + 0.5363325363 * g + 0.0514459929 * b) as x, cbrt(0.2119034982 * r + 0.6806995451 * g + 0.1073969566 * b) as y, cbrt(0.0883024619 * r + 0.2817188376 * g + 0.6299787005 * b) as z from n)
select p_partkey, round(0.2104542553 * x + 0.7936177850 * y - 0.0040720468 * z, 7) as l, round(1.9779984951 * x - 2.4285922050 * y + 0.4505937099 * z, 7) as a, round(0.0259040371 * x + 0.7827717662 * y - 0.8086757660 * z, 7) as b from m""")
def oklab_colours(spark, d):
    k = F.col("p_partkey")
    rgb = [S.linear(k * f % 256 / 255) for f in (1, 7, 13)]
    return table(spark, d, "part").select("p_partkey", S.oklab(*rgb).alias("o")).select("p_partkey", *[F.round(f"o.{n}", 7).alias(n) for n in "lab"])


@query("select o_orderkey, substr(sha256(o_orderkey || '|' || o_orderstatus || '|' || o_orderpriority), 1, 16) as digest from orders")
def content_digests(spark, d):
    return table(spark, d, "orders").select("o_orderkey", S.content_digest(F.col("o_orderkey").cast("string"), F.col("o_orderstatus"), F.col("o_orderpriority")).alias("digest"))


@query()
def keyed_identities(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").cast("string").alias("price"))
    return o.select("o_orderkey", canonical_decimal(F.col("price")).alias("price"), S.stable_id("price").alias("id"), S.split_mix("o_orderkey").alias("stream"), S.sub_seed(F.lit(7).cast("long"), F.col("o_orderkey")).alias("sub_seed"), S.long_digest("price").alias("digest"))


@query()
def gumbel_order(spark, d):
    u = S.keyed_uniform(11, "o_orderkey")
    o = table(spark, d, "orders").select("o_orderkey", S.gumbel_priority(F.col("o_totalprice") / 100000, F.lit(2), u).alias("priority"), S.log_uniform(1e-4, 1.0, u).alias("width"))
    return o.orderBy(F.desc("priority"), "o_orderkey").limit(200)


@query("""with c as (select p_partkey, (p_partkey % 256) / 255.0::double as r, (p_partkey * 7 % 256) / 255.0::double as g, (p_partkey * 13 % 256) / 128.0::double as b, case p_size % 3 when 0 then 'soft' when 1 then 'reinhard' else 'none' end as k from part), y as (select *, 0.2126 * r + 0.7152 * g + 0.0722 * b as y from c),
s as (select *, case when y > 0 then case k when 'soft' then case when y <= 0.8 then y else 0.8 + 0.2 * tanh((y - 0.8) / 0.2) end when 'reinhard' then y / (1 + y) else y end / y else 1 end as f from y)
select p_partkey, round(case when k = 'none' then r else least(r * f, 1) end, 8) as r, round(case when k = 'none' then g else least(g * f, 1) end, 8) as g, round(case when k = 'none' then b else least(b * f, 1) end, 8) as b, round(1 - (1 - r) * (1 - g), 8) as screen, round(case when (case when p_partkey % 2 = 0 then g else r end) < 0.5 then 2 * r * g else 1 - 2 * (1 - r) * (1 - g) end, 8) as overlay from s""")
def light_kept(spark, d):
    k = F.col("p_partkey")
    r, g, b = (k % 256 / 255), (k * 7 % 256 / 255), (k * 13 % 256 / 128)
    kind = F.element_at(F.array(F.lit("soft"), F.lit("reinhard"), F.lit("none")), (F.col("p_size") % 3 + 1).cast("int"))
    first = k % 2 == 0
    return table(spark, d, "part").select("p_partkey", S.light_kept(kind, r, g, b).alias("o"), F.round(S.merged(F.lit("screen"), first, r, g), 8).alias("screen"), F.round(S.merged(F.lit("overlay"), first, r, g), 8).alias("overlay")).select("p_partkey", *[F.round(f"o.{n}", 8).alias(n) for n in "rgb"], "screen", "overlay")


@query("""select p_partkey, round((p_partkey % 256) / 255.0, 6)::double as r, round((p_partkey * 7 % 256) / 255.0, 6)::double as g, round((p_partkey * 13 % 256) / 255.0, 6)::double as b from part""")
def oklab_round_trip(spark, d):
    k = F.col("p_partkey")
    lab = S.oklab(*[S.linear(k * f % 256 / 255) for f in (1, 7, 13)])
    back = table(spark, d, "part").select("p_partkey", lab.alias("o")).select("p_partkey", S.from_oklab(F.col("o.l"), F.col("o.a"), F.col("o.b")).alias("c"))
    return back.select("p_partkey", *[F.round(S.encoded(F.greatest(F.col(f"c.{n}"), F.lit(0.0))), 6).alias(n) for n in "rgb"])


@query("""select o_orderkey, round((o_orderkey % 4) / 4.0 + (o_orderkey // 4 % 4) / 16.0 + (o_orderkey // 16 % 4) / 64.0, 9)::double as address, round(o_totalprice * pow(2.0, -40) / pow(2.0, floor(log2(o_custkey + 1)) - 52), 3) as ulps, least(greatest(o_totalprice, 150.0), 400.0) as toned, case when o_totalprice < 150 then -1 when o_totalprice > 400 then 1 else 0 end as side,
  o_orderkey % 360 / 360.0::double as turn from orders""")
def addresses_and_tones(spark, d):
    k, p = F.col("o_orderkey"), F.col("o_totalprice")
    symbols = F.array(k % 4, F.floor(k / 4) % 4, F.floor(k / 16) % 4)
    angle = k % 360 / 360.0 * 6.283185307179586
    rows = table(spark, d, "orders").select("o_orderkey", F.round(S.sector_address(symbols, 4), 9).alias("address"), F.round(S.ulps(p * 2.0**-40, F.col("o_custkey") + 1), 3).alias("ulps"), S.tone_projection(p, F.lit(150.0), F.lit(400.0)).alias("t"), S.turn(F.sin(angle), F.cos(angle)).alias("turn"))
    return rows.select("o_orderkey", "address", "ulps", F.col("t.value").alias("toned"), F.col("t.side").alias("side"), F.pmod(F.round("turn", 9), F.lit(1.0)).alias("turn"))
