"""Backtests of scores without look-ahead, and the archive of forecasts against what came. Long frames: place, idx, value."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .features import logistic, national_components, open_band
from .indices import real_index
from .panel import asof, auc, episodes, lagged, ordered, spearman

#: Horizons in quarters, alarm thresholds, the fall that counts.
HORIZONS, THRESHOLDS, FALL = (4, 8, 12), (50, 60, 70, 80), 0.10


def national_history(index: DataFrame, rates: DataFrame | None = None, credit: DataFrame | None = None, rates_since: DataFrame | None = None, least: int = 40) -> DataFrame:
    """place, idx, score, growth_score, credit_score, band at each quarter, from what was known then.

    The index comes from `least` rows on.  rates: one monthly series (idx, value)
    for all places, taken to the quarter's last month and, with rates_since
    (place, year), from that year on.  credit: quarters, the last one known.
    """
    every = index.select("place", "idx").withColumn("_n", F.row_number().over(ordered())).where(F.col("_n") >= least).drop("_n")
    known = national_components(index, None, credit).withColumn("score", logistic(F.col("z")))
    of = lambda c: known.where(F.col("component") == c).select("place", "idx", F.col("score"))
    out = every
    for c in ("growth", "trend"):
        out = out.join(of(c).withColumnRenamed("score", c), ["place", "idx"], "left")
    out = asof(out, of("credit").withColumnRenamed("score", "_s"), "_s", "credit") if credit is not None else out.withColumn("credit", F.lit(None).cast("double"))
    if rates is None:
        out = out.withColumn("rates", F.lit(None).cast("double"))
    else:
        level = national_components(index.limit(0), rates.withColumn("place", F.lit(0).cast(index.schema["place"].dataType))).where("component = 'rates'").select("idx", logistic(F.col("z")).alias("_s"))
        ends = out.select("idx").distinct().select(F.lit(0).alias("place"), (F.col("idx") * 3 + 2).alias("idx"))
        seen = asof(ends, level.withColumn("place", F.lit(0)), "_s", "rates").select(F.floor(F.col("idx") / 3).cast("bigint").alias("idx"), "rates")
        out = out.join(F.broadcast(seen), "idx")  # one row a quarter
        if rates_since is not None:
            out = out.join(rates_since.select("place", F.col("year").alias("_y")), "place", "left").withColumn("rates", F.when(F.floor(F.col("idx") / 4) >= F.col("_y"), F.col("rates"))).drop("_y")
    from .features import row_mean

    out = out.withColumn("score", row_mean("growth", "trend", "rates", "credit"))
    return out.select("place", "idx", "score", F.col("growth").alias("growth_score"), F.col("credit").alias("credit_score"), open_band(F.col("score")).alias("band"))


def outcomes(nominal: DataFrame, prices: DataFrame, base_year: int = 2015, horizons: tuple[int, ...] = HORIZONS, ahead: int = 12, fall: float = FALL) -> DataFrame:
    """place, idx, ret_nom_*q, ret_real_*q, drawdown, event: what followed each quarter; the lowest real level ahead needs all of it."""
    real = real_index(nominal, prices, base_year)
    rows = nominal.select("place", "idx", F.col("value").alias("nom")).join(real.select("place", "idx", F.col("value").alias("real")), ["place", "idx"], "left")
    out = rows
    for h in horizons:
        at = lambda c: F.max(c).over(W.partitionBy("place").orderBy("idx").rangeBetween(h, h))  # noqa: B023,E731
        out = out.withColumns({f"ret_nom_{h}q": F.try_divide(at("nom"), "nom") - 1, f"ret_real_{h}q": F.try_divide(at("real"), "real") - 1})
    w = W.partitionBy("place").orderBy("idx").rangeBetween(1, ahead)
    out = out.withColumn("drawdown", F.when(F.count("real").over(w) == ahead, F.try_divide(F.min("real").over(w), "real") - 1))
    return out.withColumn("event", (F.col("drawdown") <= -fall).cast("int")).drop("nom", "real")


def alarm_rates(rows: DataFrame, score: str, thresholds: tuple[float, ...] = THRESHOLDS, group: str = "group") -> DataFrame:
    """group, threshold, hit_rate, false_alarm_rate, n_events, n_no_events; null rates unless both outcomes occur."""
    held = rows.where(F.col(score).isNotNull() & F.col("event").isNotNull()).withColumn("threshold", F.explode(F.array(*[F.lit(float(t)) for t in thresholds])))
    alarm, event = F.col(score) >= F.col("threshold"), F.col("event") == 1
    out = held.groupBy(group, "threshold").agg(F.count_if(alarm & event).alias("tp"), F.count_if(event).alias("n_events"), F.count_if(alarm & ~event).alias("fp"), F.count_if(~event).alias("n_no_events"))
    both = (F.col("n_events") > 0) & (F.col("n_no_events") > 0)
    return out.select(group, "threshold", F.when(both, F.try_divide("tp", "n_events")).alias("hit_rate"), F.when(both, F.try_divide("fp", "n_no_events")).alias("false_alarm_rate"), "n_events", "n_no_events")


def summary(rows: DataFrame, score: str, group: str = "group", horizons: tuple[int, ...] = HORIZONS) -> DataFrame:
    """group, n, spearman_*, auc_drawdown of a score."""
    out = rows.where(F.col(score).isNotNull()).groupBy(group).agg(F.count("*").alias("n"))
    for h in horizons:
        for kind in ("nom", "real"):
            out = out.join(spearman(rows, score, f"ret_{kind}_{h}q", group).select(group, F.col("rho").alias(f"spearman_{kind}_{h}q")), group, "left")
    return out.join(auc(rows, score, "event", group).withColumnRenamed("auc", "auc_drawdown"), group, "left")


def left_out(rows: DataFrame, score: str) -> DataFrame:
    """place, rho, auc over all other places: each row goes to every group but its own."""
    places = rows.select(F.col("place").alias("left")).distinct()
    others = rows.join(places, F.col("place") != F.col("left"))
    return spearman(others, score, "ret_real_12q", "left").select("left", "rho").join(auc(others, score, "event", "left"), "left", "full_outer").withColumnRenamed("left", "place")


def episode_hits(rows: DataFrame, score: str, threshold: float) -> DataFrame:
    """place, first, last, signalled: whether the score reached the threshold in each run of events."""
    runs = episodes(rows, "event").drop("n")
    inside = rows.select("place", "idx", score).join(runs, "place").where(F.col("idx").between(F.col("first"), F.col("last")))
    return inside.groupBy("place", "first", "last").agg(F.coalesce(F.bool_or(F.col(score) >= threshold), F.lit(False)).alias("signalled"))


# the archive of forecasts

ARCHIVE = "kind string, vintage string, issued string, origin string, place long, target long, h int, mid double, lo50 double, hi50 double, lo80 double, hi80 double, last_actual double"


def recorded(archive: DataFrame, forecasts: DataFrame) -> DataFrame:
    """archive with the forecasts of vintages that it has not seen; forecasts without a last actual do not count."""
    new = forecasts.where("last_actual is not null").join(archive.select("kind", "vintage").distinct(), ["kind", "vintage"], "left_anti")
    return archive.unionByName(new.select(*archive.columns))


def confronted(archive: DataFrame, actuals: DataFrame) -> DataFrame:
    """The archive with `actual` (kind, place, target), null while pending."""
    return archive.join(actuals.select("kind", "place", "target", "actual"), ["kind", "place", "target"], "left")


def judged(rows: DataFrame) -> DataFrame:
    held = rows.where("actual is not null and mid is not null and last_actual is not null")
    return held.withColumns({"err": F.log(F.col("actual") / F.col("mid")), "err_naive": F.log(F.col("actual") / F.col("last_actual")), "in80": F.col("actual").between(F.col("lo80"), F.col("hi80")), "in50": F.col("actual").between(F.col("lo50"), F.col("hi50"))})


def accuracy(rows: DataFrame, *by: str) -> DataFrame:
    """by, n, vintages, places, mae_model, mae_naive, skill, bias (positive: forecasts too high), coverage80, coverage50 of confronted forecasts."""
    share = lambda c, known=F.lit(True): F.avg(F.when(known, F.coalesce(F.col(c), F.lit(False)).cast("double")))
    out = judged(rows).groupBy(*by).agg(
        F.count("*").alias("n"), F.count_distinct("vintage").alias("vintages"), F.count_distinct("place").alias("places"), F.avg(F.abs("err")).alias("mae_model"), F.avg(F.abs("err_naive")).alias("mae_naive"),
        (-F.avg("err")).alias("bias"), share("in80").alias("coverage80"), share("in50", F.col("lo50").isNotNull()).alias("coverage50"),
    )
    return out.withColumn("skill", F.when(F.col("mae_naive") > 0, 1 - F.col("mae_model") / F.col("mae_naive")))


def archive_state(rows: DataFrame) -> DataFrame:
    """One row: archived, vintages, first issue, pending, evaluated."""
    done = F.col("actual").isNotNull() & F.col("mid").isNotNull() & F.col("last_actual").isNotNull()
    return rows.agg(F.count("*").alias("archived"), F.count_distinct("vintage").alias("vintages"), F.min("issued").alias("first_issued"), F.count_if(F.col("actual").isNull()).alias("pending"), F.count_if(done).alias("evaluated"))


def earliest_forecasts(rows: DataFrame, kind: str) -> DataFrame:
    """Of each place and target that came, the forecast that was made first (of one issue: for the longest horizon)."""
    first = F.row_number().over(W.partitionBy("place", "target").orderBy("issued", F.desc("h")))
    return judged(rows).where(F.col("kind") == kind).withColumn("_k", first).where("_k = 1").drop("_k", "err", "err_naive", "in80", "in50")


def forecast_features(sales: DataFrame, valuation: DataFrame, rates: DataFrame, edges: DataFrame, lead: int = 0, volume: DataFrame | None = None) -> DataFrame:
    """place, idx (the origin) and the nine features of a forecast, all known at the origin.

    sales: ln by quarter; valuation, volume: ln by month on a dense grid; national
    means come from place null's rows of valuation (place null: the country);
    rates: idx, value by month; edges: place, neighbour.
    """
    q = lagged(lagged(sales, 1, "_1"), 4, "_4")
    f = q.where("value is not null").select("place", "idx", "value", (F.col("value") - F.col("_1")).alias("s_mom1"), (F.col("value") - F.col("_4")).alias("s_mom4"), (F.col("idx") * 3 + 2).alias("_m"))
    f = f.withColumn("rel_level", F.col("value") - F.percentile("value", 0.5).over(W.partitionBy("idx")))

    def shifted(df: DataFrame, back: int, name: str) -> DataFrame:
        return df.select(*[c for c in df.columns if c == "place"], (F.col("idx") + back).alias("_m"), F.col("value").alias(name))

    country, places = valuation.where("place is null").drop("place"), valuation.where("place is not null")
    for df, names, key in ((country, ("_n0", "_n12", "_nl"), ["_m"]), (places, ("_v0", "_v12", "_vl"), ["place", "_m"])):
        for back, name in ((0, names[0]), (12, names[1]), (-lead, names[2])):
            f = f.join(shifted(df, back, name), key, "left")
    nat = F.col("_n0") - F.col("_n12")
    f = f.withColumns({"nat_lead": (F.col("_nl") - F.col("_n0")) if lead else F.lit(0.0), "v_mom": F.coalesce(F.col("_v0") - F.col("_v12"), nat), "v_lead": F.coalesce(F.col("_vl") - F.col("_v0"), F.col("_nl") - F.col("_n0")) if lead else F.lit(0.0)})
    near = edges.join(f.select(F.col("place").alias("neighbour"), "idx", F.col("s_mom4").alias("_s")), "neighbour").groupBy("place", "idx").agg(F.avg("_s").alias("nb_mom4"))
    f = f.join(near, ["place", "idx"], "left").withColumn("nb_mom4", F.coalesce("nb_mom4", "s_mom4"))
    ends = f.select("idx").distinct()
    for k, name in ((lead, "_e1"), (lead - 12, "_e0")):
        asked = ends.select(F.lit(0).alias("place"), (F.col("idx") * 3 + 2 + k).alias("idx"))
        seen = asof(asked, rates.select(F.lit(0).alias("place"), "idx", "value"), "value", name).select(F.floor((F.col("idx") - k) / 3).cast("bigint").alias("idx"), name)
        f = f.join(F.broadcast(seen), "idx", "left")  # one row a quarter
    f = f.withColumn("eur_chg", F.col("_e1") - F.col("_e0"))
    if volume is not None:
        for back, name in ((-lead, "_c1"), (12 - lead, "_c0")):
            f = f.join(shifted(volume, back, name), ["place", "_m"], "left")
        change = F.col("_c1") - F.col("_c0")
        f = f.withColumn("vol_chg", F.coalesce(change, F.percentile(change, 0.5).over(W.partitionBy("idx"))))
    else:
        f = f.withColumn("vol_chg", F.lit(None).cast("double"))
    return f.select("place", "idx", "s_mom1", "s_mom4", "nat_lead", "v_mom", "v_lead", "nb_mom4", "rel_level", "eur_chg", "vol_chg")


def verdict(gain_far: Column, gain_near: Column, least: float = 0.01, most_loss: float = 0.01) -> Column:
    """Whether a candidate signal passes: a gain at the far horizon without more than a small loss at the near one."""
    return (gain_far >= least) & (gain_near >= -most_loss)


def calibrated(rows: DataFrame, origins: int = 3, least: int = 60) -> DataFrame:
    """h, calibrated: enough origins and residuals (origin, h, y, pred) for error bounds."""
    held = rows.where("y is not null and pred is not null")
    return held.groupBy("h").agg(((F.count_distinct("origin") >= origins) & (F.count("*") >= least)).alias("calibrated"))


def usable(rows: DataFrame, features: list[str]) -> DataFrame:
    """feature, usable: whether a feature has two different values."""
    seen = rows.agg(*[F.count_distinct(c).alias(c) for c in features])
    return seen.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), (F.col(c) > 1).alias("usable")) for c in features])))


def growth_summary(forecasts: DataFrame, region: str = "region") -> DataFrame:
    """region (null: all), n, median, p25, p75, share_up of forecast growth (place, region, growth)."""
    made = [F.count("*").alias("n"), F.percentile("growth", 0.5).alias("median"), F.percentile("growth", 0.25).alias("p25"), F.percentile("growth", 0.75).alias("p75"), F.avg((F.col("growth") > 0).cast("double")).alias("share_up")]
    held = forecasts.where("growth is not null")
    every = held.agg(*made).select(F.lit(None).cast(forecasts.schema[region].dataType).alias(region), "n", "median", "p25", "p75", "share_up")
    return every.unionByName(held.groupBy(region).agg(*made))


def points_text(x: Column) -> Column:
    """4,6 p.p."""
    return F.concat(F.replace(F.format_string("%.1f", x * 100), F.lit("."), F.lit(",")), F.lit(" p.p."))


def reading(skill: Column, coverage: Column) -> Column:
    """better, alike or worse than the naive forecast, and whether the 80 % bounds were narrow, right or wide."""
    against = F.when(skill > 0.05, "better").when(skill < -0.05, "worse").otherwise("alike")
    bounds = F.when(coverage < 0.72, "narrow").when(coverage > 0.9, "wide").otherwise("right")
    return F.when(skill.isNotNull() & coverage.isNotNull(), F.struct(against.alias("against_naive"), bounds.alias("bounds")))
