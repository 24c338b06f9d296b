"""Queries that decide whether a head is accepted."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import measure as M
from tessera.plans.measures import _SCORED, scored
from tessera.sources.tables import table

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


#: Cutpoints of two heads over the scored rows: each lower than the one before, but for some rows of the second head.
_CUTS = f"cuts as (select *, 1 + quality + toxic + (doc_id % 2)::integer as tier, score as a2, score * 0.8 as a3, score * 0.5 as a4, other as b2, case when doc_id % 50 = 0 then null else other * 0.9 end as b3, case when doc_id % 7 = 0 then other else other * 0.4 end as b4 from ({_SCORED}))"


def cuts(spark, d):
    s, o, i = F.col("score"), F.col("other"), F.col("doc_id")
    return scored(spark, d).select("*", (1 + F.col("quality") + F.col("toxic") + (i % 2)).cast("int").alias("tier"), s.alias("a2"), (s * 0.8).alias("a3"), (s * 0.5).alias("a4"), o.alias("b2"), F.when(i % 50 != 0, o * 0.9).alias("b3"), F.when(i % 7 == 0, o).otherwise(o * 0.4).alias("b4"))


@query(f"""with {_CUTS}, x as (select count(*) as rows, count(*) filter (b2 is null or b3 is null or b4 is null) as missing, count(*) filter (coalesce(b3 > b2 + 1e-12, false) or coalesce(b4 > b3 + 1e-12, false)) as inverted from cuts)
select rows, missing, inverted, case when missing = 0 and inverted = 0 then 'PASS' else 'FAIL' end as verdict from x""")
def interface_arm(spark, d):
    return M.interface_faults(cuts(spark, d), ["b2", "b3", "b4"])


_STACK = "s as (select *, unnest([{k: 2, p: a2}, {k: 3, p: a3}, {k: 4, p: a4}]) as z from cuts)"


@query(f"""with {_CUTS}, {_STACK}, g as (select z.k as cut, avg(z.p) as predicted, avg((tier >= z.k)::integer) as observed from s group by 1)
select cut, round(predicted, 9) as predicted, round(observed, 9) as observed, round(predicted / greatest(observed, 1e-12), 6) as ratio, predicted / greatest(observed, 1e-12) between 0.75 and 1.25 as inside from g""")
def calibration_arm(spark, d):
    got = M.calibration(cuts(spark, d), {2: "a2", 3: "a3", 4: "a4"}, "tier")
    return got.select("cut", F.round("predicted", 9).alias("predicted"), F.round("observed", 9).alias("observed"), F.round("ratio", 6).alias("ratio"), "inside")


def _arms(names: str) -> str:
    return f"""z as (select arm, cut, case arm when 'a' then score else other end as s, (tier >= cut)::integer as t from cuts, (values {names}) v(arm), (values (2), (3)) w(cut)),
g as (select arm, cut, s, sum(t) as p, sum(1 - t) as q from z group by 1, 2, 3), b as (select *, coalesce(sum(q) over (partition by arm, cut order by s rows between unbounded preceding and 1 preceding), 0) as below from g),
auc as (select arm, cut, sum(p) as positives, case when sum(p) > 0 and sum(q) > 0 then sum(p * (below + q / 2)) / (sum(p) * sum(q)) end as auc from b group by 1, 2)"""


@query(f"""with {_CUTS}, {_arms("('a'), ('b')")} select cut, round(min(auc), 9) as low, round(max(auc), 9) as high, round(avg(auc), 9) as mean, max(positives)::bigint as positives from auc group by cut""")
def yardstick_band(spark, d):
    got = M.yardstick(cuts(spark, d), "tier", {"a": {2: "score", 3: "score"}, "b": {2: "other", 3: "other"}})
    return got.select("cut", *[F.round(c, 9).alias(c) for c in ("low", "high", "mean")], "positives")


@query(f"with {_CUTS} select count(*) as rows, round(avg((d = tier)::integer), 9) as agreement, round(avg((abs(d - tier) <= 1)::integer), 9) as within_one from (select tier, 1 + (a2 >= 0.5)::integer + (a3 >= 0.5)::integer + (a4 >= 0.5)::integer as d from cuts)")
def agreement_arm(spark, d):
    got = M.tier_agreement(cuts(spark, d), "tier", ["a2", "a3", "a4"])
    return got.select("rows", F.round("agreement", 9).alias("agreement"), F.round("within_one", 9).alias("within_one"))


@query()
def paired_auc_interval(spark, d):
    got = M.paired_auc(cuts(spark, d), "source", "quality", "score", "other")
    return got.withColumn("verdict", M.verdict(F.col("low"), F.col("high")))


@query()
def seed_precision(spark, d):
    """The widest interval of the AUC difference over the pairs of three arms."""
    rows = cuts(spark, d).withColumn("third", (F.col("score") + F.col("other")) / 2)
    every = None
    for a, b in (("score", "other"), ("score", "third"), ("other", "third")):
        one = M.paired_auc(rows, "source", "quality", a, b, draws=200).select(F.lit(f"{a}-{b}").alias("pair"), (F.col("high") - F.col("low")).alias("width"))
        every = one if every is None else every.unionByName(one)
    return every.agg(F.max("width").alias("width"), F.max_by("pair", "width").alias("pair"))


@query()
def overall_arm(spark, d):
    """Cross-entropy of the middle candidate run against the incumbent, per label, with its interval over sources."""
    rows = cuts(spark, d)
    loss = lambda c: M.log_loss(F.col(c), F.col("quality"))
    each = rows.select("source", loss("score").alias("a"), loss("other").alias("b")).withColumn("delta", F.col("a") - F.col("b"))
    got = M.cluster_bootstrap(each, "source", "delta", 1000)
    return got.withColumn("verdict", F.when(F.col("low") > 0, "FAIL").otherwise("PASS"))


@query()
def consistency_arm(spark, d):
    """Whether one head's ranks at a cheap read agree more with its own at the full read than another head's do."""
    rows = cuts(spark, d).withColumn("c1", F.round("score", 1)).withColumn("c2", F.round("other", 1))
    got = M.paired_rank_correlation(rows, "source", (("score", "c1"), ("other", "c2")))
    return got.withColumn("verdict", M.verdict(F.col("low"), F.col("high")))


@query()
def flip_bar(spark, d):
    rows = cuts(spark, d).withColumn("cheap", F.round("score", 1)).withColumn("rough", F.round("other", 1))
    return M.flip_bar(rows, "source", ["lang"], {"junk": 0.1, "keep": 0.385, "great": 0.8}, ("cheap", "score"), ("rough", "other"))


@query(f"""with s as ({_SCORED}), g as (select lang, round(score, 1) as h, score as t from s) select lang, count(*) filter (t >= 0.385 and h < 0.385) as turned_off, count(*) filter (t < 0.385 and h >= 0.385) as turned_on from g group by lang""")
def flip_direction(spark, d):
    got = M.flips(scored(spark, d).withColumn("cheap", F.round("score", 1)), "score", "cheap", 0.385, ["lang"])
    return got.select("lang", F.col("lost").alias("turned_off"), F.col("gained").alias("turned_on"))


_RESTATE = ", ".join(f"('{c}', {v})" for c, v in (("junk", 0.1), ("keep", 0.385), ("great", 0.8)))


@query(f"""with s as ({_SCORED}), c as (select * from (values {_RESTATE}) v(cut, prior)), k as (select cut, prior::double as prior, count(*) filter (score >= prior) as passing from c, s group by 1, 2), r as (select other, row_number() over (order by other desc) as i from s),
x as (select cut, prior, passing, case when passing = 0 then 1.0 else other end as crossing from k left join r on i = passing), v as (select *, round(floor(crossing / 0.005 + 1e-9) * 0.005, 3) as value from x)
select cut, prior, passing, round(crossing, 9) as crossing, value, count(*) filter (other >= value) as realised, count(*) filter ((score >= prior) <> (other >= value)) as churn from v, s group by 1, 2, 3, 4, 5""")
def cut_restatement(spark, d):
    return M.restated_cuts(scored(spark, d), "score", "other", {"junk": 0.1, "keep": 0.385, "great": 0.8}).withColumn("crossing", F.round("crossing", 9))


#: Candidate sets: a customer's orders, with a student's and a teacher's score and the one that was recorded.
_SETS = """sets as (select o_custkey as k, o_custkey % 3 as batch, o_orderkey as i, (o_orderkey * 7 % 97) / 97.0::double as a, (o_orderkey * 13 % 89) / 89.0::double as b, o_orderkey = min(o_orderkey) over (partition by o_custkey) as rec from orders),
rk as (select *, rank() over (partition by k order by a) + (count(*) over (partition by k, a) - 1) / 2 as ra, rank() over (partition by k order by b) + (count(*) over (partition by k, b) - 1) / 2 as rb from sets),
e as (select batch, k, case when count(distinct ra) > 1 and count(distinct rb) > 1 then corr(ra, rb) end as rho, arg_max(i, a * 1e6 - i * 1e-9) as pick, arg_max(i, b * 1e6 - i * 1e-9) as best, max(i) filter (rec) as rec, arg_max(b, a * 1e6 - i * 1e-9) as got, max(b) as high, min(b) as low from rk group by 1, 2),
l as (select *, case when high > low then (high - got) / (high - low) else 0 end as lost from e)"""
_HEAD = "count(*) as sets, round(avg((pick = best)::integer), 9) as agreement, round(median(rho), 6) as median_rho, round(avg(lost), 9) as mean_regret, round(median(lost), 9) as median_regret, round(quantile_cont(lost, 0.9), 9) as p90_regret, round(avg((best = rec)::integer), 9) as control, round(avg((pick = rec)::integer), 9) as production"


def sets(spark, d):
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("k"), (F.col("o_custkey") % 3).alias("batch"), F.col("o_orderkey").alias("i"), (F.col("o_orderkey") * 7 % 97 / 97).alias("a"), (F.col("o_orderkey") * 13 % 89 / 89).alias("b"))
    first = o.groupBy("k").agg(F.min("i").alias("f"))
    return o.join(first, "k").withColumn("rec", F.col("i") == F.col("f")).drop("f")


def _rounded(frame, *keep):
    return frame.select(*keep, "sets", *[F.round(c, 6 if c == "median_rho" else 9).alias(c) for c in ("agreement", "median_rho", "mean_regret", "median_regret", "p90_regret", "control", "production")])


@query(f"with {_SETS} select {_HEAD} from l")
def head_measure(spark, d):
    return _rounded(M.head_measure(sets(spark, d), "k", "i", "a", "b", "rec"))


@query(f"with {_SETS} select batch, {_HEAD} from l group by batch")
def head_measure_by_batch(spark, d):
    return _rounded(M.head_measure(sets(spark, d), "k", "i", "a", "b", "rec", ["batch"]), "batch")


@query(f"with {_SETS} select round(avg(l), 9) as loss from (select k, avg(power((a - ma) - (b - mb), 2)) as l from (select *, avg(a) over (partition by k) as ma, avg(b) over (partition by k) as mb from sets) group by k)")
def set_loss(spark, d):
    return M.set_loss(sets(spark, d), "k", "a", "b").withColumn("loss", F.round("loss", 9))


@query(f"""with {_SETS}, h as (select k, i, a, round(a, 2) as r from sets), p as (select k, arg_max(i, a * 1e6 - i * 1e-9) <> arg_max(i, r * 1e6 - i * 1e-9) as moved from h group by k)
select (select count(*) from p) as sets, (select count(*) filter (moved) from p) as changed, round(median(abs(r - a)), 9) as median_move, round(quantile_cont(abs(r - a), 0.99), 9) as p99_move, round(max(abs(r - a)), 9) as worst_move from h""")
def rounding_agreement(spark, d):
    got = M.changed_picks(sets(spark, d).withColumn("r", F.round("a", 2)), "k", "i", "a", "r")
    return got.select("sets", "changed", *[F.round(c, 9).alias(c) for c in ("median_move", "p99_move", "worst_move")])
