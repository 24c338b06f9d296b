"""Queries on identities of places, predicates on their rows, and the joins by identity.

A ledger is read from ``orders``: each order gives a family, a frame of decimal texts, a fate and scores.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import places as P
from tessera.operators import joins as J
from tessera.operators import select as S
from tessera.operators.resolve import latest
from tessera.sources.tables import table

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


#: The ledger in SQL, a row per order; coordinates are texts with zeros at their end.
_LEDGER = """l0 as (select o_orderkey as id, o_custkey as cust, 'walk' || (o_custkey % 3) as ledger, o_orderdate as recorded_at,
  case o_orderkey % 5 when 0 then 'mandelbrot' when 1 then 'multibrot' when 2 then 'julia' when 3 then 'phoenix' else 'other' end as kind,
  case when o_custkey % 3 = 0 then null else 2 + o_custkey % 5 end as degree, o_orderkey % 13 <> 0 as framed,
  (o_custkey % 5 - 2) || '.' || lpad((o_orderkey % 40)::varchar, 2, '0') || '00' as re, '0.' || lpad((o_custkey % 100)::varchar, 2, '0') || '0' as im, case o_custkey % 4 when 0 then '3' when 1 then '1.50' when 2 then '0.2500' else '0.010' end as width,
  case o_orderkey % 7 when 0 then 'survived' when 1 then 'expandable' when 2 then 'not_admitted' when 3 then 'interior' when 4 then 'spread' else 'survived' end as fate,
  case when o_custkey % 6 = 0 then null else (o_orderkey % 101) / 100.0::double end as score, case when o_custkey % 8 = 0 then null else (o_custkey % 97) / 400.0::double end as great from orders)"""
_TEXT = "case when {0} like '%.%' then regexp_replace(regexp_replace({0}, '0+$', ''), '[.]$', '') else {0} end"


def _zero(x: str) -> str:
    return f"(case when {_TEXT.format(x)} = '-0' then '0' else {_TEXT.format(x)} end)"


_KEYED = (
    _LEDGER
    + """, l1 as (select *, coalesce(degree, 2) as d, case when coalesce(degree, 2) = 2 then 'mandelbrot' else 'multibrot' || degree end as plane from l0),
l2 as (select *, case when kind in ('mandelbrot', 'phoenix') then case when kind = 'phoenix' and cust % 5 = 0 then 'phoenix:classic' else kind end when d > 5 then null when kind = 'multibrot' then plane when kind = 'julia' then 'julia:' || plane end as part from l1),
l3 as (select *, case when part is null or not framed then null else '["' || part || '", ' || d || ', [' || case kind when 'julia' then '["-0.4", "0.' || (1 + cust % 9) || '"]' when 'phoenix' then case when cust % 5 = 0 then '["0.5667", "0"], null, null' else '["0.3", "0"], ["-0.5", "0"], null' end else '' end
  || '], "' || """
    + _zero("re")
    + """ || '", "' || """
    + _zero("im")
    + """ || '", "' || """
    + _TEXT.format("width")
    + """ || '"]' end as key from l2)"""
)


def ledger(spark, d) -> DataFrame:
    """Rows of three ledgers with families and frames; one order in five has a family of no partition, one in thirteen
    no frame."""
    o, k, c = table(spark, d, "orders"), F.col("o_orderkey"), F.col("o_custkey")
    kind = F.element_at(F.array(*map(F.lit, ["mandelbrot", "multibrot", "julia", "phoenix", "other"])), (k % 5 + 1).cast("int"))
    degree = F.when(c % 3 != 0, 2 + c % 5).cast("int")
    pair = lambda a, b: F.array(a if not isinstance(a, str) else F.lit(a), b if not isinstance(b, str) else F.lit(b))
    seed = F.when(kind == "julia", pair("-0.40", F.concat(F.lit("0."), (1 + c % 9).cast("string"), F.lit("0")))).when(kind == "phoenix", F.when(c % 5 == 0, pair("0.56670", "0")).otherwise(pair("0.30", "-0")))
    second = F.when((kind == "phoenix") & (c % 5 != 0), pair("-0.50", "0.0"))
    family = F.struct(kind.alias("kind"), degree.alias("degree"), seed.alias("c"), second.alias("p"), F.lit(None).cast("array<string>").alias("z_prev"))
    re = F.concat((c % 5 - 2).cast("string"), F.lit("."), F.lpad((k % 40).cast("string"), 2, "0"), F.lit("00"))
    im = F.concat(F.lit("0."), F.lpad((c % 100).cast("string"), 2, "0"), F.lit("0"))
    width = F.element_at(F.array(*map(F.lit, ["3", "1.50", "0.2500", "0.010"])), (c % 4 + 1).cast("int"))
    frame = F.when(k % 13 != 0, F.struct(re.alias("center_re"), im.alias("center_im"), width.alias("width")))
    fate = F.element_at(F.array(*map(F.lit, ["survived", "expandable", "not_admitted", "interior", "spread", "survived", "survived"])), (k % 7 + 1).cast("int"))
    return o.select(k.alias("id"), c.alias("cust"), F.concat(F.lit("walk"), (c % 3).cast("string")).alias("ledger"), F.col("o_orderdate").alias("recorded_at"), family.alias("family"), frame.alias("viewport"),
                    fate.alias("fate"), F.when(c % 6 != 0, (k % 101) / 100.0).alias("score"), F.when(c % 8 != 0, (c % 97) / 400.0).alias("great"))


def keyed(spark, d) -> DataFrame:
    rows = ledger(spark, d)
    return rows.withColumn("part", P.partition_of(F.col("family"))).withColumn("key", P.location_key(F.col("family"), F.col("viewport")))


@query(f"with {_KEYED} select id, part, key, part = 'phoenix:classic' as classic from l3")
def location_keys(spark, d):
    return keyed(spark, d).select("id", "part", "key", (F.col("part") == "phoenix:classic").alias("classic"))


@query(f"""with {_KEYED} select id, case when id % 2 = 0 then case when part like 'j%' then null else part end else part end as part from l3""")
def partition_of_rows(spark, d):
    rows = keyed(spark, d)
    name = F.when((F.col("id") % 2 == 0) & ~F.coalesce(F.col("part").startswith("j"), F.lit(False)), F.coalesce("part", F.lit("unknown")))
    family = F.when(F.col("id") % 2 == 1, F.col("family"))
    return rows.select("id", P.partition_of_row(name, family).alias("part"))


@query(f"""with {_KEYED} select id, case when part is not null then '["' || part || '", ' || d || ', [' || case when kind = 'phoenix' then case when cust % 5 = 0 then 'null, null' else '["-0.5", "0"], null' end else '' end || ']]' end as plane from l3""")
def plane_identities(spark, d):
    return ledger(spark, d).select("id", P.plane_identity(F.col("family")).alias("plane"))


_RECIPE = "'{\"cycles\": \"' || (cust % 4) || '\", \"gamma\": \"1.0\", \"mirror\": \"false\", \"phase\": \"0.0\", \"reverse\": \"false\", \"rolloff\": \"none\", \"transfer\": \"value\"}'"


def rendered(spark, d) -> DataFrame:
    rows = keyed(spark, d)
    c = F.col("cust")
    recipe = F.create_map(*[x for k, v in (("gamma", F.lit("1.0")), ("cycles", (c % 4).cast("string")), ("phase", F.lit("0.0")), ("reverse", F.lit("false")), ("mirror", F.lit("false")), ("transfer", F.lit("value")), ("rolloff", F.lit("none"))) for x in (F.lit(k), v)])
    # One recipe in seven lacks its roll-off.
    recipe = F.when(c % 7 == 0, F.map_filter(recipe, lambda k, _: k != "rolloff")).otherwise(recipe)
    settings = F.create_map(F.lit("trap"), F.concat(F.lit("t"), (c % 3).cast("string")), F.lit("bands"), F.lit("4"))
    return rows.withColumn("render", P.render_key(F.col("key"), F.lit("stripe"), settings, F.lit("sqrt"), F.concat(F.lit("map"), (c % 5).cast("string")), recipe))


_RENDERED = _KEYED + f""", l4 as (select *, case when cust % 7 <> 0 then key || ' | stripe | {{"bands": "4", "trap": "t' || (cust % 3) || '"}} | sqrt | map' || (cust % 5) || ' | ' || {_RECIPE} end as render from l3)"""


@query(f"with {_RENDERED} select id, render from l4")
def render_keys(spark, d):
    return rendered(spark, d).select("id", "render")


@query(f"""with {_RENDERED} select render, max_by(id, recorded_at || lpad(id::varchar, 12, '0')) as id, count(*) - 1 as superseded from l4 where render is not null group by render""")
def resolve_renders(spark, d):
    rows = rendered(spark, d).where("render is not null").select("render", "recorded_at", "id")
    return latest(rows, ["render"], [F.col("recorded_at"), F.col("id")]).select("render", "id", "superseded")


@query("select p_partkey, case when p_size % 3 = 0 then 1.0 else p_size / 10.0 end as gamma, case when p_size % 4 = 0 then 1.0 else p_size % 7 end::double as cycles, 0.0::double as phase, p_size % 2 = 1 as reverse, false as mirror, case when p_size % 5 = 0 then 'value' else 'rank' end as transfer, 'none' as rolloff from part")
def normal_recipes(spark, d):
    s, none = F.col("p_size"), F.lit(None)
    r = P.normal_recipe(F.when(s % 3 != 0, s / 10.0), F.when(s % 4 != 0, s % 7), none, F.when(s % 2 == 1, F.lit(True)), none, F.when(s % 5 != 0, F.lit("rank")), none)
    return table(spark, d, "part").select("p_partkey", r.alias("r")).select("p_partkey", "r.*")


@query(f"""with {_LEDGER} select id, fate in ('survived', 'expandable', 'not_admitted') as gates, fate in ('survived', 'expandable', 'not_admitted') and coalesce(score >= 0.385, false) as admitted, coalesce(score >= 0.1, false) as junk_floor, score >= 0.385 as clears,
  case when coalesce(score >= 0.385, false) then case when coalesce(great >= 0.105, false) then 4 else 3 end end as cls, case when score < 0.05 then 0 when score < 0.2 then 1 when score < 0.5 then 2 when score < 0.8 then 3 when score is not null then 4 end as band from l0""")
def admission(spark, d):
    f, s, g = F.col("fate"), F.col("score"), F.col("great")
    return ledger(spark, d).select("id", P.passes_gates(f).alias("gates"), P.is_admitted(f, s).alias("admitted"), P.acts(s, P.JUNK_FLOOR).alias("junk_floor"), P.clears(s, P.GOOD_FLOOR).alias("clears"), P.good_class(s, g).alias("cls"), P.score_band(s).alias("band"))


@query("""select l_orderkey, l_linenumber, case when l_quantity < 2 then null when ln(l_quantity / 2) / ln(25.0) < 1 / 3.0::double then 'deep' when ln(l_quantity / 2) / ln(25.0) < 2 / 3.0::double then 'middle' else 'shallow' end as band,
  l_tax >= 0.04 as advised, case when l_tax >= 0.04 then 'over' when l_tax < 0.04 then 'under' end as note, coalesce(l_discount >= 0.05, false) as by_rule from lineitem""")
def bands_and_advice(spark, d):
    q, t = F.col("l_quantity"), F.col("l_tax")
    # An advisory cut is a column; it filters nothing.
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", P.depth_band(q, 2.0, 50.0).alias("band"), P.clears(t, 0.04).alias("advised"), F.when(t >= 0.04, "over").when(t < 0.04, "under").alias("note"), P.served_by_rule(F.col("l_discount"), 0.05).alias("by_rule"))


@query(f"""with {_KEYED}, r as (select id, case when id % 17 = 0 then 2 else 1 end as schema, case when id % 11 = 0 then '' else 'b' end as batch, case when id % 6 = 0 then null else id % 6 end as score, case when id % 19 = 0 then 'model' when id % 2 = 0 then 'rule:edge' else 'human' end as origin, case when id % 23 = 0 then null else 't' end as stamp, key from l3)
select fault, count(*) as n from (select case when schema <> 1 then 'schema' when batch = '' then 'batch' when score = 5 then 'score' when origin = 'model' then 'origin' when stamp is null then 'recorded_at' when key is null then 'identity' end as fault from r) group by 1""")
def label_faults(spark, d):
    i = F.col("id")
    fault = P.label_fault(F.when(i % 17 == 0, 2).otherwise(1), F.when(i % 11 == 0, "").otherwise("b"), F.when(i % 6 != 0, i % 6), F.when(i % 19 == 0, "model").when(i % 2 == 0, "rule:edge").otherwise("human"), F.when(i % 23 != 0, "t"), F.col("key"))
    return keyed(spark, d).select(fault.alias("fault")).groupBy("fault").agg(F.count("*").alias("n"))


@query(f"""with {_LEDGER} select id, kind, coalesce(w1, 1920)::bigint as across, coalesce(ss, 2)::bigint as supersample, coalesce(mode, 'smooth') as mode, mi as maxiter from (
  select id, kind, framed, case id % 3 when 0 then 640 when 1 then null else 1280 end as w1, case when id % 4 = 0 then 4 end as ss, case when id % 5 = 0 then 'stripe' end as mode, case when id % 2 = 0 then id % 1000 end as mi from l0) where framed""")
def location_records(spark, d):
    i = F.col("id")
    # One row in three is flat, one keeps its place under a name of its own, one has a render block on the row.
    flat = F.struct(F.when(i % 3 == 0, 640).alias("across"), F.when(i % 4 == 0, 4).alias("supersample"), F.when(i % 5 == 0, "stripe").alias("mode"))
    block = F.struct(F.when(i % 3 == 2, 1280).otherwise(F.when(i % 3 == 0, 640)).alias("across"), F.when(i % 4 == 0, 4).alias("supersample"), F.when(i % 5 == 0, "stripe").alias("mode"))
    place = F.struct("family", "viewport")
    rows = ledger(spark, d).select("id", F.when(i % 3 == 1, place).alias("location"), F.when(i % 3 != 1, F.col("family")).alias("family"), F.when(i % 3 != 1, F.col("viewport")).alias("viewport"), F.when(i % 3 == 0, flat).otherwise(block).alias("render"), F.when(i % 2 == 0, i % 1000).alias("maxiter"))
    return J.location_record(rows).where("viewport is not null").select("id", "family.kind", F.col("across").cast("long").alias("across"), F.col("supersample").cast("long").alias("supersample"), "mode", "maxiter")


@query(f"""with {_KEYED}, r as (select id, part, id % 2 as head, score, row_number() over (partition by part, id % 2 order by score desc nulls last, id) as rank from l3 where part is not null and fate = 'survived' and id % 9 <> 0 and id % 10 <> 0)
select id, part, head, rank::integer as rank, (row_number() over (order by rank, part, head, id))::integer as place from r""")
def served_rows(spark, d):
    i = F.col("id")
    rows = keyed(spark, d).where("part is not null").select("id", "part", (i % 2).alias("head"), "score", F.when(F.col("fate") == "survived", "released").otherwise("passed_over").alias("verdict"), F.when(i % 9 != 0, "x.png").alias("picture"), F.when(i % 10 == 0, "over").alias("rejected"))
    return S.served(rows, "part", "head", "score", "id").select("id", "part", "head", "rank", "place")


@query("""with n as (select o_orderkey, case when o_custkey % 4 = 0 then null else o_custkey % 3 end as score, 'b' || o_custkey % 2 as batch from orders), c as (select o_orderkey, case when o_custkey % 4 = 0 then null else o_orderkey % 3 end as score, 'b0' as batch from orders)
select o_orderkey, (n.score is not distinct from c.score) and n.batch = c.batch as says from n join c using (o_orderkey)""")
def already_says(spark, d):
    c, k = F.col("o_custkey"), F.col("o_orderkey")
    new = F.when(c % 4 != 0, c % 3)
    old = F.when(c % 4 != 0, k % 3)
    return table(spark, d, "orders").select("o_orderkey", P.already_says(new, F.lit("human"), F.concat(F.lit("b"), (c % 2).cast("string")), old, F.lit("human"), F.lit("b0")).alias("says"))


@query("select o_orderkey, case when o_totalprice < 300 then 'passed_over' when o_custkey % 3 = 0 then 'killed' else 'released' end as verdict, coalesce(quality >= 3, false) as keeper from orders left join (select doc_id, quality * 3 as quality from labels) on doc_id = o_orderkey")
def release_verdicts(spark, d):
    marks = table(spark, d, "labels").select(F.col("doc_id").alias("o_orderkey"), (F.col("quality") * 3).alias("mark"))
    rows = table(spark, d, "orders").join(marks, "o_orderkey", "left")
    picture = F.when(F.col("o_custkey") % 3 != 0, "x.png")
    return rows.select("o_orderkey", P.release_verdict(F.col("o_totalprice") >= 300, picture).alias("verdict"), P.is_keeper(F.col("mark")).alias("keeper"))


@query("""select c_custkey, substr(sha256('["' || c_name || '","' || c_mktsegment || '"]'), 1, 16) as name, case when c_custkey % 2 = 0 then '/new/' || c_name else 'hot/' || c_name end as path, '2024-05-' || lpad((1 + c_custkey % 28)::varchar, 2, '0') || 'T01:02:03Z' as stamp,
  case when c_custkey < 60 then c_custkey || 's' when c_custkey < 3600 then (c_custkey // 60) || 'm ' || lpad((c_custkey % 60)::varchar, 2, '0') || 's' else (c_custkey // 3600) || 'h ' || lpad((c_custkey % 3600 // 60)::varchar, 2, '0') || 'm' end as took, printf('%.2f GiB', c_custkey * 10000000 / 1073741824.0::double) as size from customer""")
def picture_names(spark, d):
    k, n = F.col("c_custkey"), F.col("c_name")
    path = F.when(k % 2 == 0, F.concat(F.lit("/old/"), n)).otherwise(F.concat(F.lit("hot/"), n))
    at = F.make_timestamp_ntz(F.lit(2024), F.lit(5), (1 + k % 28).cast("int"), F.lit(1), F.lit(2), F.lit(3.4))
    return table(spark, d, "customer").select("c_custkey", P.digest_name(n, F.col("c_mktsegment")).alias("name"), P.rehomed(path, "/old/", "/new").alias("path"), P.date_stamp(at).alias("stamp"), P.human_time(k).alias("took"), P.human_size(k * 10_000_000).alias("size"))


@query(f"""with {_LEDGER} select id, kind || case when coalesce(degree, 2) <> 2 then ' d' || degree else '' end || case kind when 'julia' then ' c=-0.40,0.' || (1 + cust % 9) || '0' when 'phoenix' then case when cust % 5 = 0 then ' c=0.56670,0' else ' c=0.30,-0 p=-0.50,0.0' end else '' end as family, case when framed then re || ' ' || im || ' w=' || width else '' end as frame from l0""")
def display_lines(spark, d):
    return ledger(spark, d).select("id", P.family_line(F.col("family")).alias("family"), F.coalesce(P.viewport_line(F.col("viewport")), F.lit("")).alias("frame")).withColumn("frame", F.when(F.col("frame").startswith("w="), "").otherwise(F.col("frame")))


# Joins by identity.
_SIDE = ", side as (select key, max(score) * 0.9 as p_ge3, (max(id) % 3 = 0) as other_head from l3 where key is not null and id % 4 <> 0 group by key)"


def sidecar(spark, d) -> DataFrame:
    return keyed(spark, d).where("key is not null and id % 4 <> 0").groupBy("key").agg((F.max("score") * 0.9).alias("p_ge3"), (F.max("id") % 3 == 0).alias("other_head"))


@query(f"""with {_KEYED}{_SIDE}, g as (select l3.*, side.key as k2, p_ge3 from l3 left join side using (key) where l3.key is not null and fate in ('survived', 'expandable', 'not_admitted'))
select part, count(*) as found, count(k2) as scored, count(*) filter (p_ge3 >= 0.1) as passing, count(*) filter (p_ge3 >= 0.385) as good, (count(*) filter (p_ge3 >= 0.1)) // 4 as cap, part || ': ' || count(*) || ' found, ' || count(k2) || ' scored, ' || (count(*) filter (p_ge3 >= 0.1)) || ' passing, ' || (count(*) filter (p_ge3 >= 0.385)) || ' good' as line from g group by part""")
def score_join(spark, d):
    offer = J.scored_offer(keyed(spark, d), sidecar(spark, d), "key", "fate", "p_ge3")
    return J.funnel(offer, "part", "p_ge3")


@query(f"""with {_KEYED}{_SIDE}, g as (select id, part, key, p_ge3 as score, row_number() over (partition by part order by p_ge3 desc, key, id) as place from l3 join side using (key) where fate in ('survived', 'expandable', 'not_admitted') and p_ge3 >= 0.1)
select id, part, key, round(score, 9) as score, place::integer as place from g""")
def ranked_offer(spark, d):
    offer = J.scored_offer(keyed(spark, d), sidecar(spark, d), "key", "fate", "p_ge3").where(P.acts(F.col("p_ge3"), P.JUNK_FLOOR))
    return offer.select("id", "part", "key", F.round("p_ge3", 9).alias("score"), S.best_first_by("part", "p_ge3", ["key", "id"]).alias("place"))


@query(f"""with {_KEYED}{_SIDE}, lab as (select distinct key from l3 where key is not null and id % 10 = 1)
select case when key in (select key from lab) then 'labelled' when other_head then 'other_head' else 'eligible' end as state, count(*) as n from side group by 1""")
def labelled_exclusion(spark, d):
    labelled = keyed(spark, d).where("key is not null and id % 10 = 1").select("key").distinct()
    return J.excluded(sidecar(spark, d), labelled, "key", F.col("other_head")).groupBy("state").agg(F.count("*").alias("n"))


@query(f"""with {_KEYED} select id, key from l3 where key is not null and score >= 0.2 and key not in (select key from l3 where key is not null and id % 20 = 1 union select key from l3 where key is not null and id % 33 = 2)""")
def reserved_exclusion(spark, d):
    rows = keyed(spark, d).where("key is not null").select("id", "key", "score")
    pinned, used = rows.where("id % 20 = 1").select("key"), rows.where("id % 33 = 2").select("key")
    return J.without_places(rows.where("score >= 0.2").select("id", "key"), [pinned, used], "key")


@query("""with t as (select l_orderkey as location_id, list(l_partkey order by l_linenumber, l_partkey) as tiles, count(*) as n, max(l_quantity) as other from lineitem group by 1)
select o_orderkey as location_id, o_orderstatus as side, tiles, tiles[1] as canonical, n from orders join t on location_id = o_orderkey""")
def tiles_join(spark, d):
    places = table(spark, d, "orders").select(F.col("o_orderkey").alias("location_id"), F.col("o_orderstatus").alias("side"))
    tiles = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("location_id"), F.col("l_linenumber").alias("slot"), F.col("l_partkey").alias("tile"))
    # Orders without lines are no places here; the join itself refuses a place without tiles.
    places = places.join(tiles.select("location_id").distinct(), "location_id", "left_semi")
    other = tiles.withColumn("tile", F.col("tile") * 2)
    return J.with_tiles(places, tiles, [other], "location_id", "slot", "tile").select("location_id", "side", "tiles", F.col("tiles")[0].alias("canonical"), F.size("tiles").cast("long").alias("n"))


@query(f"""with {_KEYED}, m as (select key, min(cust) as other_id from l3 where key is not null group by key), s as (select id, key, score from l3 where key is not null and score is not null) select id, other_id, score from s join m using (key)""")
def cross_project_join(spark, d):
    rows = keyed(spark, d).where("key is not null")
    other = rows.groupBy("key").agg(F.min("cust").alias("other_id"))
    return rows.where("score is not null").select("id", "key", "score").join(other, "key").select("id", "other_id", "score")


@query(f"""with {_KEYED}, pins as (select distinct key from l3 where key is not null and id % 15 = 1), s as (select id, key, case when id % 5 = 0 then 'eval' else 'train' end as side from l3 where key is not null)
select id, case when key in (select key from pins) then 'eval' else side end as side, (side = 'train' and key in (select key from pins)) as violation from s""")
def pinned_sides(spark, d):
    rows = keyed(spark, d).where("key is not null")
    sides = rows.select("id", "key", F.when(F.col("id") % 5 == 0, "eval").otherwise("train").alias("side"))
    pins = rows.where("id % 15 = 1").select("key").distinct()
    return J.pinned(sides, pins, "key", "side").select("id", "side", "violation")


@query("""select p_partkey, p_brand, o.units as exported, case when o.units is null then 'unanswered' when p_partkey is null then 'unknown' when o.units > 1 then 'repeated' else 'joined' end as state
from part full join (select l_partkey + 20 as l_partkey, count(*) as units from lineitem where l_quantity = 7 group by 1) o on p_partkey = l_partkey""")
def sheet_export(spark, d):
    export = table(spark, d, "lineitem").where("l_quantity = 7").select((F.col("l_partkey") + 20).alias("p_partkey"))
    sheet = table(spark, d, "part").select("p_partkey", "p_brand")
    return J.sheet_export(sheet, export, "p_partkey").select(F.when(F.col("state") != "unknown", F.col("p_partkey")).alias("p_partkey"), "p_brand", F.col("units").alias("exported"), "state")


@query("""with p as (select s_suppkey as id, s_nationkey as part, s_acctbal / 100 as x, (s_suppkey * 37 % 101)::double as y from supplier)
select a.part, coalesce(round(min(sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2))), 9), 'infinity'::double) as distance from p a left join p b on a.part = b.part and a.id < b.id group by a.part""")
def closest_pairs(spark, d):
    p = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("part"), (F.col("s_acctbal") / 100).alias("x"), (F.col("s_suppkey") * 37 % 101).cast("double").alias("y"))
    return J.closest_pair(p, "part").select("part", F.round("distance", 9).alias("distance"))


@query(f"""with {_KEYED} select id, part, score, bar from (select *, case when part like 'julia%' then 0.5 when part = 'phoenix' then 0.7 end as bar from l3 where fate = 'survived' and id % 9 <> 0) where bar is not null and not coalesce(score >= bar, false)""")
def below_bar(spark, d):
    bars = spark.createDataFrame([(p, 0.5 if p.startswith("julia") else 0.7) for p in P.PARTITIONS if p.startswith("julia") or p == "phoenix"], "part string, bar double")
    served = keyed(spark, d).where("fate = 'survived' and id % 9 <> 0")
    return J.below_bar(served, bars, "part", "score").select("id", "part", "score", "bar")


@query(f"""with {_KEYED}, k as (select key, part, max(id % 5) as tier from l3 where key is not null and id % 2 = 0 and id % 5 >= 3 group by key, part)
select part, tier, count(*) as n, min(key) as first from k group by part, tier""")
def proven_roots(spark, d):
    labels = keyed(spark, d).select("key", "part", (F.col("id") % 5).alias("tier"), F.when(F.col("id") % 2 == 0, "human").otherwise("rule:x").alias("origin"))
    roots = J.proven_roots(labels, "key", "part", "tier", "origin")
    return roots.groupBy("part", "tier").agg(F.count("*").alias("n"), F.min("key").alias("first"))


@query(f"""with {_LEDGER}, v as (select kind, re::double as x, im::double as y, width::double as w from l0 where framed and ledger <> 'walk1') select kind as part, count(*) as visits, count(distinct (x, y, w)) as places, round(max(w), 9) as widest from v group by kind""")
def visited_index(spark, d):
    v = J.visits(ledger(spark, d).where("viewport is not null"), "ledger", "walk1", F.col("family.kind"))
    return v.groupBy("part").agg(F.count("*").alias("visits"), F.count_distinct("x", "y", "width").alias("places"), F.round(F.max("width"), 9).alias("widest"))


@query(f"""with {_KEYED} select part, count(*) as candidates, count(score) as cheap, count(great) as canonical, count(*) filter (score is not null and great is not null) as pairs, count(*) filter (fate in ('survived', 'expandable', 'not_admitted')) as units, count(*) filter (fate in ('survived', 'expandable', 'not_admitted') and coalesce(score >= 0.385, false)) as admitted from l3 where key is not null group by part""")
def sheet_units(spark, d):
    rows = keyed(spark, d).where("key is not null")
    f, s, g = F.col("fate"), F.col("score"), F.col("great")
    return rows.groupBy("part").agg(F.count("*").alias("candidates"), F.count(s).alias("cheap"), F.count(g).alias("canonical"), F.count_if(s.isNotNull() & g.isNotNull()).alias("pairs"), F.count_if(P.passes_gates(f)).alias("units"), F.count_if(P.is_admitted(f, s)).alias("admitted"))


@query(f"""with {_KEYED} select fate, count(*) as n, count(key) as keyed, count(distinct key) as places, count(key) - count(distinct key) as repeated, round(sum(case when coalesce(score >= 0.385, false) then case when coalesce(great >= 0.105, false) then 1.0 else 0.1 end else 0 end), 6)::double as currency from l3 group by fate""")
def row_accounting(spark, d):
    """Rows by fate, of them keyed, distinct and repeated places, and currency; each adds up to all rows."""
    cls = P.good_class(F.col("score"), F.col("great"))
    worth = F.when(cls == 4, 1.0).when(cls == 3, 0.1).otherwise(0.0)
    return keyed(spark, d).groupBy("fate").agg(F.count("*").alias("n"), F.count("key").alias("keyed"), F.count_distinct("key").alias("places"), (F.count("key") - F.count_distinct("key")).alias("repeated"), F.round(F.sum(worth), 6).alias("currency"))


@query(f"""with {_KEYED}, u as (select *, row_number() over (partition by key order by ledger, id) as i from l3 where key is not null and fate in ('survived', 'expandable', 'not_admitted')),
lab as (select distinct key from l3 where key is not null and id % 10 = 1), m as (select *, key in (select key from lab) as labelled, case when coalesce(score >= 0.385, false) then case when coalesce(great >= 0.105, false) then 4 else 3 end end as cls from u where i = 1)
select part, count(*) as found, count(*) filter (labelled) as suppressed, count(*) filter (not labelled and cls is null) as unclassed, count(*) filter (not labelled and cls = 3) as n3, count(*) filter (not labelled and cls = 4) as n4 from m group by part""")
def machine_census(spark, d):
    rows = keyed(spark, d)
    labelled = rows.where("key is not null and id % 10 = 1").select("key").distinct()
    return J.machine_census(rows, labelled, "part", "key", ["ledger", "id"])
