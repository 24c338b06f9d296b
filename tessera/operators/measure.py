"""Evaluation statistics of scorers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _ties(rows: DataFrame, by: list[str], score: str, label: str) -> DataFrame:
    """One row per distinct score: its positives and negatives, and the negatives below it."""
    got = rows.where(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy(*by, score).agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("q"))
    below = Window.partitionBy(*by).orderBy(score).rowsBetween(Window.unboundedPreceding, -1)
    return got.withColumn("below", F.coalesce(F.sum("q").over(below), F.lit(0)))


def auc(rows: DataFrame, score: str, label: str, by: list[str] | None = None) -> DataFrame:
    """Area under the ROC curve by mid-ranks; null where a class is absent. Scores are pre-aggregated, so the window
    runs over distinct scores only."""
    by = by or []
    s = _ties(rows, by, score, label).groupBy(*by).agg(F.sum(F.col("p") * (F.col("below") + F.col("q") / 2)).alias("u"), F.sum("p").alias("positives"), F.sum("q").alias("negatives"))
    return s.select(*by, "positives", "negatives", F.when((F.col("positives") > 0) & (F.col("negatives") > 0), F.col("u") / (F.col("positives") * F.col("negatives"))).alias("auc"))


def average_precision(rows: DataFrame, score: str, label: str, tie: str) -> DataFrame:
    """Mean precision at the hits in falling score (0 to 1); ties keep the order of ``tie``; null without hits.

    Scores fall into 4,096 bands. Rows are counted within a band; bands add their totals."""
    cut = rows.withColumn("_b", -F.floor(F.col(score) * 4096))
    before = Window.partitionBy().orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    band = cut.groupBy("_b").agg(F.count("*").alias("_n"), F.sum(label).alias("_p"))
    band = band.select("_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_rows"), F.coalesce(F.sum("_p").over(before), F.lit(0)).alias("_hits"))
    w = Window.partitionBy("_b").orderBy(F.desc(score), tie)
    s = cut.withColumn("_i", F.row_number().over(w)).withColumn("_h", F.sum(label).over(w.rowsBetween(Window.unboundedPreceding, 0))).join(band, "_b")
    return s.agg(F.avg(F.when(F.col(label) == 1, (F.col("_h") + F.col("_hits")) / (F.col("_i") + F.col("_rows")))).alias("average_precision"))


def log_loss(p: Column, t: Column, least: float = 1e-7) -> Column:
    q = F.least(F.greatest(p, F.lit(least)), F.lit(1 - least))
    return -(t * F.ln(q) + (1 - t) * F.ln(1 - q))


def mid_rank(rows: DataFrame, column: str, by: list[str], name: str) -> DataFrame:
    """``(by, column, name)``: the mid-rank of each distinct value, from counts, so that no window sorts rows."""
    counts = rows.groupBy(*by, column).agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(*by).orderBy(column).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return counts.select(*by, column, (before + (F.col("_n") + 1) / 2).alias(name))


def spearman(rows: DataFrame, x: str, y: str, by: list[str] | None = None) -> DataFrame:
    """Pearson correlation of mid-ranks over the rows that have both; null where one side is flat.

    Rows are counted by their pair of values, and distinct values are ranked.
    """
    by = by or []
    pairs = rows.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(*by, x, y).agg(F.count("*").alias("_w"))
    whole = rows.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    r = pairs.join(mid_rank(whole, x, by, "_a"), [*by, x]).join(mid_rank(whole, y, by, "_b"), [*by, y])
    # Ranks are taken from the middle, so that sums of squares don't cancel.
    n, w = F.sum("_w"), F.col("_w")
    mean = lambda c: F.sum(w * F.col(c)) / n
    m = r.groupBy(*by).agg(mean("_a").alias("_ma"), mean("_b").alias("_mb"))
    r = r.join(m, by) if by else r.crossJoin(F.broadcast(m))  # a row per group
    a, b = F.col("_a") - F.col("_ma"), F.col("_b") - F.col("_mb")
    s = r.groupBy(*by).agg(F.sum(w * a * a).alias("aa"), F.sum(w * b * b).alias("bb"), F.sum(w * a * b).alias("ab"))
    return s.select(*by, F.when((F.col("aa") > 0) & (F.col("bb") > 0), F.col("ab") / F.sqrt(F.col("aa") * F.col("bb"))).alias("rho"))


def discordant(sets: DataFrame, key: str, order: str, x: str, y: str) -> DataFrame:
    """Pairs within a set that the two scores put in opposite order. Sets are candidate lists of bounded length, kept
    as arrays: no pair row is made."""
    s = sets.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(order, x, y))).alias("s"))
    inner = lambda a, i: F.size(F.filter(F.slice("s", i + 2, F.size("s")), lambda b: F.signum(a[x] - b[x]) * F.signum(a[y] - b[y]) < 0))
    return s.select(key, F.aggregate(F.transform("s", inner), F.lit(0), lambda t, v: t + v).alias("discordant"), F.size("s").alias("n"))


def flips(rows: DataFrame, here: str, there: str, edge: float, by: list[str] | None = None) -> DataFrame:
    """Decisions that move between two reads at a gate, and which way."""
    a, b = F.col(here) >= edge, F.col(there) >= edge
    return rows.groupBy(*(by or [])).agg(F.count_if(a != b).alias("flips"), F.count_if(a & ~b).alias("lost"), F.count_if(~a & b).alias("gained"), F.count("*").alias("n"))


def passing_counts(counts: DataFrame, score: str, n: str, bands: int = 4096) -> DataFrame:
    """Counts of distinct scores with ``past``, how many rows score as much or more. Scores from 0 to 1 fall into bands:
    a task adds up one band, and the bands' totals are added in order."""
    cut = counts.withColumn("_b", -F.floor(F.col(score) * bands))
    before = Window.partitionBy().orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    total = cut.groupBy("_b").agg(F.sum(n).alias("_t")).select("_b", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_before"))
    own = F.sum(n).over(Window.partitionBy("_b").orderBy(F.desc(score)))
    return cut.withColumn("_own", own).join(total, "_b").withColumn("past", F.col("_before") + F.col("_own")).drop("_b", "_own", "_before")


def volume_match(rows: DataFrame, incumbent: str, candidate: str, prior: float, step: float = 0.005) -> DataFrame:
    """The candidate's cut that passes as many rows as the incumbent's, floored to ``step``."""
    k = rows.agg(F.count_if(F.col(incumbent) >= prior).alias("k"))
    ranked = passing_counts(rows.groupBy(candidate).agg(F.count("*").alias("n")), candidate, "n")
    both = ranked.crossJoin(F.broadcast(k)).where("past >= k and past - n < k")  # one row
    return both.select("k", F.col(candidate).alias("crossing"), (F.floor(F.col(candidate) / step + 1e-9) * step).alias("cut"))


def verdict(low: Column, high: Column, lower_is_better: bool = False) -> Column:
    """What an interval of candidate minus incumbent says; one that holds zero, or isn't there, says nothing."""
    better, worse = (high < 0, low > 0) if lower_is_better else (low > 0, high < 0)
    return F.when(better, "IMPROVED").when(worse, "WORSENED").otherwise("NOT_RESOLVED")


def multiplicities(groups: DataFrame, group: str, draws: int, seed: int = 0) -> DataFrame:
    """``(group, draw, t)``: how often each group is in each resample, where it is at all. Poisson(1) by a keyed hash, so
    draws are the same on any cluster."""
    table = np.cumsum([np.exp(-1) / float(np.prod(np.arange(1, k + 1))) for k in range(8)]).tolist()
    each = groups.select(group).distinct().withColumn("draw", F.explode(F.sequence(F.lit(0), F.lit(draws - 1))))
    u = F.pmod(F.xxhash64(F.col(group).cast("string"), "draw", F.lit(seed)), F.lit(1 << 52)) / float(1 << 52)
    return each.withColumn("t", sum((F.when(u >= edge, 1).otherwise(0) for edge in table), F.lit(0))).where("t > 0")


def _interval(drawn: DataFrame, value: str) -> DataFrame:
    return drawn.agg(*[F.percentile(F.col(value), F.lit(p)).alias(c) for p, c in ((0.025, "low"), (0.5, "middle"), (0.975, "high"))], F.count(value).alias("draws"), F.count_if(F.col(value).isNull()).alias("undefined"))


def paired_auc(rows: DataFrame, group: str, label: str, ours: str, theirs: str, draws: int = 400, seed: int = 0) -> DataFrame:
    """Interval of the difference of two scores' AUC over whole groups drawn with replacement, both from the same draws.

    Rows are first counted by group, score and label; a draw weighs these counts, and its AUC is a running sum over its
    distinct scores. Draws without both classes are counted and left out.
    """
    times = multiplicities(rows, group, draws, seed)

    def of(score: str) -> DataFrame:
        counts = rows.groupBy(group, F.col(score).alias("s")).agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("q"))
        drawn = counts.join(times, group).groupBy("draw", "s").agg(F.sum(F.col("p") * F.col("t")).alias("p"), F.sum(F.col("q") * F.col("t")).alias("q"))
        below = F.coalesce(F.sum("q").over(Window.partitionBy("draw").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        u = drawn.withColumn("u", F.col("p") * (below + F.col("q") / 2)).groupBy("draw").agg(F.sum("u").alias("u"), F.sum("p").alias("p"), F.sum("q").alias("q"))
        return u.select("draw", F.when((F.col("p") > 0) & (F.col("q") > 0), F.col("u") / (F.col("p") * F.col("q"))).alias(score))

    return _interval(of(ours).join(of(theirs), "draw").withColumn("d", F.col(ours) - F.col(theirs)), "d")


def paired_rank_correlation(rows: DataFrame, group: str, pairs: tuple[tuple[str, str], tuple[str, str]], draws: int = 200, seed: int = 0) -> DataFrame:
    """Interval of the difference of two rank correlations (ours, theirs) over whole groups drawn with replacement.

    Ranks are those of the whole table, weighed by the draws: one pass over the rows ranks them, and a draw needs sums
    alone.
    """
    ranked = rows
    for k, column in enumerate({c for p in pairs for c in p}):
        ranked = ranked.join(mid_rank(rows, column, [], f"_r{k}_{column}"), column)
    names = {c: n for n in ranked.columns if n.startswith("_r") for c in [n.split("_", 2)[2]]}
    sums = []
    for i, (x, y) in enumerate(pairs):
        a, b = F.col(names[x]), F.col(names[y])
        sums += [F.sum(e).alias(f"{n}{i}") for n, e in (("x", a), ("y", b), ("xx", a * a), ("yy", b * b), ("xy", a * b))]
    per = ranked.groupBy(group).agg(F.count("*").alias("n"), *sums)
    drawn = per.join(multiplicities(rows, group, draws, seed), group).groupBy("draw").agg(*[F.sum(F.col(c) * F.col("t")).alias(c) for c in per.columns if c != group])

    def rho(i: int) -> Column:
        n, x, y, xx, yy, xy = (F.col(c) for c in ("n", f"x{i}", f"y{i}", f"xx{i}", f"yy{i}", f"xy{i}"))
        spread = (n * xx - x * x) * (n * yy - y * y)
        return F.when(spread > 0, (n * xy - x * y) / F.sqrt(spread))

    return _interval(drawn.withColumn("d", rho(0) - rho(1)), "d")


def interface_faults(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows that lack a cutpoint, rows whose cutpoints rise where they may only fall, and whether there are none."""
    missing = F.lit(False)
    for c in columns:
        missing = missing | F.col(c).isNull()
    inverted = F.lit(False)
    for a, b in zip(columns, columns[1:]):
        inverted = inverted | (F.col(b) > F.col(a) + 1e-12)
    got = rows.agg(F.count("*").alias("rows"), F.count_if(missing).alias("missing"), F.count_if(F.coalesce(inverted, F.lit(False))).alias("inverted"))
    return got.withColumn("verdict", F.when((F.col("missing") == 0) & (F.col("inverted") == 0), "PASS").otherwise("FAIL"))


def calibration(rows: DataFrame, columns: dict[int, str], label: str, low: float = 0.75, high: float = 1.25) -> DataFrame:
    """Per cutpoint the mean prediction over the share of labels at or above it, and whether that is within tolerance."""
    stack = F.explode(F.array(*[F.struct(F.lit(k).alias("cut"), F.col(c).alias("p"), (F.col(label) >= k).cast("double").alias("t")) for k, c in columns.items()]))
    got = rows.select(stack.alias("z")).groupBy("z.cut").agg(F.avg("z.p").alias("predicted"), F.avg("z.t").alias("observed"))
    return got.withColumn("ratio", F.col("predicted") / F.greatest(F.col("observed"), F.lit(1e-12))).withColumn("inside", F.col("ratio").between(low, high))


def yardstick(rows: DataFrame, label: str, arms: dict[str, dict[int, str]]) -> DataFrame:
    """AUC of each arm at each cutpoint as least, greatest and mean over the arms."""
    stack = F.explode(F.array(*[F.struct(F.lit(a).alias("arm"), F.lit(k).alias("cut"), F.col(c).alias("s"), (F.col(label) >= k).cast("int").alias("t")) for a, cuts in arms.items() for k, c in cuts.items()]))
    each = auc(rows.select(stack.alias("z")).select("z.*"), "s", "t", ["arm", "cut"])
    return each.groupBy("cut").agg(F.min("auc").alias("low"), F.max("auc").alias("high"), F.avg("auc").alias("mean"), F.max("positives").alias("positives"))


def head_measure(sets: DataFrame, key: str, order: str, student: str, teacher: str, recorded: str, by: list[str] | None = None) -> DataFrame:
    """How a student chooses within sets: how often it agrees with the teacher, the median rank correlation, what a
    choice costs against the set's spread (mean, median, 90th percentile), and how often teacher and student choose
    what was recorded (``recorded`` marks that row). Sets are candidate lists of bounded length."""
    by = by or []
    rho = spearman(sets, student, teacher, [*by, key])
    first = lambda c: F.max_by(F.col(order), F.struct(F.col(c), -F.col(order)))  # noqa: E731  the first of the greatest
    each = sets.groupBy(*by, key).agg(
        first(student).alias("pick"), first(teacher).alias("best"), F.max_by(F.col(order), F.col(recorded).cast("int")).alias("recorded"), F.max_by(F.col(teacher), F.struct(F.col(student), -F.col(order))).alias("got"),
        F.max(teacher).alias("high"), F.min(teacher).alias("low"),
    ).join(rho, [*by, key])
    lost = F.when(F.col("high") > F.col("low"), (F.col("high") - F.col("got")) / (F.col("high") - F.col("low"))).otherwise(0.0)
    each = each.withColumn("lost", lost)
    share = lambda a, b: F.avg((F.col(a) == F.col(b)).cast("double"))
    return each.groupBy(*by).agg(F.count("*").alias("sets"), share("pick", "best").alias("agreement"), F.median("rho").alias("median_rho"), F.avg("lost").alias("mean_regret"), F.median("lost").alias("median_regret"), F.percentile("lost", F.lit(0.9)).alias("p90_regret"), share("best", "recorded").alias("control"), share("pick", "recorded").alias("production"))


def set_loss(sets: DataFrame, key: str, ours: str, theirs: str) -> DataFrame:
    """Mean over sets of the mean squared difference of scores, each centred in its set."""
    a, b = F.col(ours), F.col(theirs)
    # Of centred differences: the mean square less the square of the mean.
    each = sets.groupBy(key).agg((F.avg((a - b) * (a - b)) - F.avg(a - b) * F.avg(a - b)).alias("l"))
    return each.agg(F.avg("l").alias("loss"))


def changed_picks(sets: DataFrame, key: str, order: str, before: str, after: str) -> DataFrame:
    """How much a head moved: sets with another first choice, and moves of single scores (median, 99th percentile, most)."""
    first = lambda c: F.max_by(F.col(order), F.struct(F.col(c), -F.col(order)))
    picks = sets.groupBy(key).agg((first(before) != first(after)).alias("moved")).agg(F.count("*").alias("sets"), F.count_if("moved").alias("changed"))
    gap = F.abs(F.col(after) - F.col(before))
    moves = sets.agg(F.median(gap).alias("median_move"), F.percentile(gap, F.lit(0.99)).alias("p99_move"), F.max(gap).alias("worst_move"))
    return picks.crossJoin(F.broadcast(moves))  # one row


def tier_agreement(rows: DataFrame, label: str, cutpoints: list[str], edge: float = 0.5) -> DataFrame:
    """Share of rows whose decoded tier is the label, and of those within one tier."""
    tier = sum((F.when(F.col(c) >= edge, 1).otherwise(0) for c in cutpoints), F.lit(1))
    hit, near = (tier == F.col(label)).cast("double"), (F.abs(tier - F.col(label)) <= 1).cast("double")
    return rows.agg(F.count("*").alias("rows"), F.avg(hit).alias("agreement"), F.avg(near).alias("within_one"))


def restated_cuts(rows: DataFrame, incumbent: str, candidate: str, cuts: dict[str, float], step: float = 0.005) -> DataFrame:
    """Each cut as the candidate's score that passes as many rows, rounded down to ``step``, with what it then passes, and
    how many rows the two don't both pass. Only distinct candidate scores are put in order."""
    counts = rows.groupBy(candidate).agg(F.count("*").alias("n"), *[F.count_if(F.col(incumbent) >= v).alias(f"k_{c}") for c, v in cuts.items()])
    ranked = passing_counts(counts, candidate, "n")
    total = counts.agg(F.sum("n").alias("total"), *[F.sum(f"k_{c}").alias(f"all_{c}") for c in cuts])
    both = ranked.crossJoin(F.broadcast(total))  # one row
    crossing = both.agg(F.first("total").alias("total"), *[F.first(f"all_{c}").alias(f"all_{c}") for c in cuts], *[F.max(F.when((F.col("past") >= F.col(f"all_{c}")) & (F.col("past") - F.col("n") < F.col(f"all_{c}")), F.col(candidate))).alias(f"x_{c}") for c in cuts])
    stack = F.explode(F.array(*[F.struct(F.lit(c).alias("cut"), F.lit(v).alias("prior"), F.col(f"all_{c}").alias("passing"), F.when(F.col(f"all_{c}") == 0, 1.0).otherwise(F.col(f"x_{c}")).alias("crossing")) for c, v in cuts.items()]))
    out = crossing.select("total", stack.alias("z")).select("total", "z.*").withColumn("value", F.round(F.floor(F.col("crossing") / step + 1e-9) * step, 3))
    # A handful of cuts: each row meets them all.
    met = rows.crossJoin(F.broadcast(out.select("cut", "prior", "value"))).groupBy("cut").agg(F.count_if(F.col(candidate) >= F.col("value")).alias("realised"), F.count_if((F.col(incumbent) >= F.col("prior")) != (F.col(candidate) >= F.col("value"))).alias("churn"))
    return out.join(met, "cut").select("cut", "prior", "passing", "crossing", "value", "realised", "churn")


def flip_bar(rows: DataFrame, unit: str, by: list[str], gates: dict[str, float], ours: tuple[str, str], theirs: tuple[str, str], draws: int = 400, seed: int = 0) -> DataFrame:
    """Per cell the share of gates at which a head's decision moves between two reads, candidate and incumbent, the
    interval of their difference over units, and its verdict; a lower share is better."""

    def share(pair: tuple[str, str]) -> Column:
        moved = [((F.col(pair[0]) >= e) != (F.col(pair[1]) >= e)).cast("double") for e in gates.values()]
        return sum(moved[1:], moved[0]) / len(moved)

    each = rows.select(*by, unit, share(ours).alias("a"), share(theirs).alias("b"))
    per = each.groupBy(*by, unit).agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.count("*").alias("n"))
    drawn = per.join(multiplicities(rows, unit, draws, seed), unit).groupBy(*by, "draw").agg(((F.sum(F.col("a") * F.col("t")) - F.sum(F.col("b") * F.col("t"))) / F.sum(F.col("n") * F.col("t"))).alias("d"))
    bounds = drawn.groupBy(*by).agg(F.percentile("d", F.lit(0.025)).alias("low"), F.percentile("d", F.lit(0.975)).alias("high"))
    means = each.groupBy(*by).agg(F.avg("a").alias("candidate"), F.avg("b").alias("incumbent"), F.count("*").alias("n"))
    return means.join(bounds, by).withColumn("verdict", verdict(F.col("low"), F.col("high"), lower_is_better=True))


def cluster_bootstrap(rows: DataFrame, group: str, value: str, draws: int = 5000, seed: int = 0) -> DataFrame:
    """Mean of ``value`` over whole groups drawn with replacement: 2.5, 50 and 97.5 percentiles of ``draws`` resamples.

    A resample needs each group's sum and count alone. Groups meet Poisson(1) multiplicities drawn from a keyed hash,
    so draws are the same on any cluster and nothing grows with the rows. Empty draws don't count.
    """
    sums = rows.groupBy(group).agg(F.sum(value).alias("s"), F.count(value).alias("n"))
    drawn = sums.join(multiplicities(rows, group, draws, seed), group).groupBy("draw").agg(F.sum(F.col("s") * F.col("t")).alias("s"), F.sum(F.col("n") * F.col("t")).alias("n")).where("n > 0")
    return _interval(drawn.withColumn("m", F.col("s") / F.col("n")), "m").drop("undefined")


def regret(sets: DataFrame, key: str, order: str, student: str, teacher: str) -> DataFrame:
    """What the student's first choice costs on the teacher's scale, whether it is the teacher's too, and the spread."""
    s = sets.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(order, student, teacher))).alias("s"))
    a, b = F.transform("s", lambda z: z[student]), F.transform("s", lambda z: z[teacher])
    pick, best = F.array_position(a, F.array_max(a)), F.array_position(b, F.array_max(b))
    return s.select(key, (F.array_max(b) - F.element_at(b, pick.cast("int"))).alias("regret"), (pick == best).alias("top_pick"), (F.array_max(b) - F.array_min(b)).alias("spread"))
