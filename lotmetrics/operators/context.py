"""Market and housing context: valuations against prices, cycles, credit, supply, effort, costs, countries. Frames are long: place, idx, value."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.finance import instalment
from .features import change, latest, outer
from .indices import last_twelve, real_index, resampled, rolling_total, to_annual, window_mean
from .panel import asof, lagged, ordered, top_movers

#: Smallest volume of a listed place; area, financed share and term of the reference home.
MIN_VOLUME, AREA, FINANCED, TERM = 20, 90, 0.9, 30


def at_last(df: DataFrame, back: int = 0) -> DataFrame:
    last = df.agg(F.max("idx")).scalar()
    return df.where(F.col("idx") == last - back)


# valuations and cycle


def valuation_gaps(sales: DataFrame, valuation: DataFrame) -> DataFrame:
    """place, idx, gap, change: the mean valuation of the twelve months that a quarter's price covers over that price, less 1, and its change in a year."""
    means = window_mean(valuation, sales.where("value is not null"))
    gaps = sales.join(means, ["place", "idx"]).select("place", "idx", change("mean", "value").alias("value")).where("value is not null")
    return lagged(gaps, 4, "_before").select("place", "idx", F.col("value").alias("gap"), (F.col("value") - F.col("_before")).alias("change"))


def valuation_gap(sales: DataFrame, valuation: DataFrame) -> DataFrame:
    """The gaps of the last quarter of sales."""
    last = sales.where("value is not null").agg(F.max("idx")).scalar()
    return valuation_gaps(sales, valuation).where(F.col("idx") == last).drop("idx")


def gap_summary(gaps: DataFrame) -> DataFrame:
    c = F.col("change")
    return gaps.agg(F.count("gap").alias("n"), F.percentile("gap", 0.5).alias("median_gap"), F.percentile(c, 0.5).alias("median_change"), F.avg(F.when(c.isNotNull(), (c > 0).cast("double"))).alias("share_widening"), F.count(c).alias("n_change"))


def listed(df: DataFrame, value: str, volume: DataFrame | None, k: int = 10, least: float = MIN_VOLUME) -> DataFrame:
    """The k smallest and largest values among places with enough volume (place, volume)."""
    if volume is not None:
        df = df.join(volume.where(F.col("volume") >= least), "place", "left_semi")
    return top_movers(df, value, k)


def cycle_phases(feats: DataFrame) -> DataFrame:
    """feats (price_growth_1y, val_count, val_count_growth_1y and more) with the phase, for places with enough volume and finite growth."""
    p, v = F.col("price_growth_1y"), F.col("val_count_growth_1y")
    held = feats.where(p.isNotNull() & v.isNotNull() & (F.abs(v) < float("inf")) & ~F.isnan(v) & (F.col("val_count") >= MIN_VOLUME))
    phase = F.when((p > 0) & (v > 0), "up_up").when(p > 0, "up_down").when(v <= 0, "down_down").otherwise("down_up")
    return held.withColumn("phase", phase)


def cycle_summary(phases: DataFrame) -> DataFrame:
    """phase, n and the medians of both growths."""
    return phases.groupBy("phase").agg(F.count("*").alias("n"), F.percentile("price_growth_1y", 0.5).alias("median_price_growth"), F.percentile("val_count_growth_1y", 0.5).alias("median_volume_growth"))


def late_cycle(phases: DataFrame, k: int = 10) -> DataFrame:
    return phases.where("phase = 'up_down'").orderBy("val_count_growth_1y", "place").limit(k)


def national_cycle(valuation: DataFrame, counts: DataFrame) -> DataFrame:
    """place, idx (quarter), price, volume: yearly growth of the quarter's mean valuation (three months) and of its last month's count."""
    price = lagged(resampled(valuation.where("value is not null"), 3), 4, "p0").withColumnRenamed("value", "p1")
    ends = counts.where("value is not null and pmod(idx, 3) = 2").select("place", F.floor(F.col("idx") / 3).cast("bigint").alias("idx"), "value")
    volume = lagged(ends, 4, "v0").withColumnRenamed("value", "v1")
    rows = price.join(volume, ["place", "idx"]).where("p0 is not null and v0 > 0")
    return rows.select("place", "idx", change("p1", "p0").alias("price"), change("v1", "v0").alias("volume"))


def credit_flow(volume: DataFrame, pure: DataFrame | None = None) -> DataFrame:
    """place, until, last12, change, peak, peak_at and, with new credit proper, pure12 and reneg_share. From 36 months on."""
    roll = lagged(rolling_total(volume), 12, "before")
    enough = volume.where("value is not null").groupBy("place").agg(F.count("*").alias("_n")).where("_n >= 36").select("place")
    roll = roll.join(enough, "place", "left_semi")
    roll = roll.withColumn("_top", F.max("value").over(W.partitionBy("place")))
    out = roll.groupBy("place").agg(
        F.max("idx").alias("until"), F.max_by("value", "idx").alias("last12"), F.max_by(change("value", "before"), "idx").alias("change"), F.max("value").alias("peak"),
        F.min(F.when(F.col("value") == F.col("_top"), F.col("idx"))).alias("peak_at"),
    )
    if pure is None:
        return out
    own = rolling_total(pure).select("place", F.col("idx").alias("until"), F.col("value").alias("pure12"))
    return out.join(own, ["place", "until"], "left").withColumn("reneg_share", F.when(F.col("last12") > 0, 1 - F.col("pure12") / F.col("last12")))


def last_and_year_ago(df: DataFrame, step: int = 12) -> DataFrame:
    """place (a series), idx, value, year_ago: each series' own last known value and the one a year before."""
    rows = lagged(df.where("value is not null"), step, "year_ago")
    return rows.groupBy("place").agg(F.max("idx").alias("idx"), F.max_by("value", "idx").alias("value"), F.max_by("year_ago", "idx").alias("year_ago"))


def as_fraction(value: Column) -> Column:
    """Percentages above 1 as fractions."""
    return F.when(value > 1, value / 100).otherwise(value)


# supply


def shares_of_year(df: DataFrame) -> DataFrame:
    """kind, idx, share: of the year's total, over years that all kinds have. df: kind, idx, value."""
    kinds = df.select("kind").distinct().count()
    w = W.partitionBy("idx")
    rows = df.where("value is not null").withColumns({"_k": F.count("*").over(w), "_t": F.sum("value").over(w)}).where(F.col("_k") == kinds)
    return rows.select("kind", "idx", F.try_divide("value", "_t").alias("share"))


def typology_mix(yearly: DataFrame, prices: DataFrame) -> DataFrame:
    """kind, share_now, share_before (five years), price_growth_1y (four rows): needs six years and both ends.

    yearly: kind, idx, value; prices: kind, idx (quarters), value.
    """
    shares = shares_of_year(yearly)
    span = F.broadcast(shares.agg(F.max("idx").alias("y1"), F.count_distinct("idx").alias("n")).where("n >= 6"))  # one row
    at = lambda k: F.max(F.when(F.col("idx") == F.col("y1") - k, F.col("share")))
    mix = shares.crossJoin(span).groupBy("kind").agg(at(0).alias("share_now"), at(5).alias("share_before")).where("share_before is not null")
    w = W.partitionBy("kind").orderBy("idx")
    growth = prices.where("value is not null").withColumn("_before", F.lag("value", 4).over(w)).groupBy("kind").agg(F.max_by(change("value", "_before"), "idx").alias("price_growth_1y"))
    return mix.join(growth, "kind", "left")


def supply_series(counts: DataFrame, kind: str, stock: DataFrame | None = None) -> DataFrame:
    """place, idx (year), value, per_1000: totals of complete years, per thousand homes of the last known stock."""
    rows = to_annual(counts, kind)
    if stock is None:
        return rows.withColumn("per_1000", F.lit(None).cast("double"))
    seen = asof(rows, stock.withColumnRenamed("value", "stock"), "stock", "_stock")
    return seen.select("place", "idx", "value", (F.try_divide("value", "_stock") * 1000).alias("per_1000"))


def recent_total(counts: DataFrame, n: int) -> DataFrame:
    """place, until, last, change: the last n known rows against the n before; both must be there."""
    back = F.row_number().over(W.partitionBy("place").orderBy(F.desc("idx")))
    rows = counts.where("value is not null").withColumn("_b", back).where(F.col("_b") <= 2 * n)
    sums = rows.groupBy("place").agg(F.max("idx").alias("until"), F.count("*").alias("_n"), F.sum(F.when(F.col("_b") <= n, F.col("value"))).alias("last"), F.sum(F.when(F.col("_b") > n, F.col("value"))).alias("_p")).where(F.col("_n") == 2 * n)
    return sums.select("place", "until", "last", F.when(F.col("_p") > 0, F.col("last") / F.col("_p") - 1).alias("change"))


# effort


def quarterly_rate(monthly: DataFrame) -> DataFrame:
    """idx (quarter) and rate: the mean of the months that are there."""
    return monthly.where("value is not null").groupBy(F.floor(F.col("idx") / 3).cast("bigint").alias("idx")).agg(F.avg("value").alias("rate"))


def payment(price: Column, rate: Column) -> Column:
    return instalment(price * AREA * FINANCED, rate, F.lit(TERM))


def effort_history(prices: DataFrame, mortgage: DataFrame, incomes: dict[str, DataFrame], months: dict[str, int]) -> DataFrame:
    """place, idx, payment and, for each income, effort_*: the reference home's instalment over the income of the year or of up to two years before.

    prices: quarters; mortgage: months of one series; incomes: years; months: by
    how many months an income is divided.
    """
    rows = prices.where("value is not null").join(quarterly_rate(mortgage), "idx").withColumn("payment", payment(F.col("value"), F.col("rate")))
    rows = rows.select("place", F.col("idx").alias("quarter"), F.floor(F.col("idx") / 4).cast("bigint").alias("idx"), "payment")
    for name, df in incomes.items():
        rows = asof(rows, df.where("value > 0").withColumnRenamed("value", "income"), "income", f"_{name}", 2)
        rows = rows.withColumn(f"effort_{name}", F.col("payment") / (F.col(f"_{name}") / months[name])).drop(f"_{name}")
    return rows.drop("idx").withColumnRenamed("quarter", "idx")


def extremes(df: DataFrame, value: str) -> DataFrame:
    """place, low, low_at, high, high_at: the earliest of equal ones."""
    own = df.where(F.col(value).isNotNull())
    return own.groupBy("place").agg(
        F.min(value).alias("low"), F.min_by("idx", F.struct(F.col(value), "idx")).alias("low_at"), F.max(value).alias("high"), F.min_by("idx", F.struct(-F.col(value), "idx")).alias("high_at")
    )


def effort_medians(efforts: DataFrame, names: list[str]) -> DataFrame:
    held = F.coalesce(*[F.col(f"effort_{n}") for n in names]).isNotNull()
    return efforts.where(held).groupBy("idx").agg(*[F.percentile(f"effort_{n}", 0.5).alias(f"effort_{n}") for n in names])


def effort_risers(efforts: DataFrame, name: str) -> DataFrame:
    """place, first, last, change, doubled between the first and the last key of all."""
    held = efforts.where(F.col(f"effort_{name}").isNotNull())
    ends = F.broadcast(held.agg(F.min("idx").alias("a"), F.max("idx").alias("b")))  # one row
    at = lambda k: F.max(F.when(F.col("idx") == F.col(k), F.col(f"effort_{name}")))
    rows = held.crossJoin(ends).groupBy("place").agg(at("a").alias("first"), at("b").alias("last")).where("first is not null and last is not null")
    return rows.withColumns({"change": F.col("last") - F.col("first"), "doubled": F.col("last") >= 2 * F.col("first")})


def since_base(df: DataFrame, begin: int, end: int, step: int) -> DataFrame:
    """place, until, yoy, since: growth of each series' last value over a year and over the mean of begin..end."""
    rows = lagged(df.where("value is not null"), step, "_before")
    base = F.avg(F.when(F.col("idx").between(begin, end), F.col("value")))
    return rows.groupBy("place").agg(F.max("idx").alias("until"), F.max_by(change("value", "_before"), "idx").alias("yoy"), (F.try_divide(F.max_by("value", "idx"), base) - 1).alias("since"))


# context of places


def context_features(yearly: dict[str, DataFrame], growths: tuple[str, ...] = (), brackets: list[DataFrame] | None = None, guests: DataFrame | None = None, guests_local: DataFrame | None = None, per_100: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """A row for each place: latest yearly levels and growths, income brackets as shares, guests of twelve months, ratios (name: part, whole; per 100)."""
    parts = []
    for name, df in yearly.items():
        row = latest(df, {"_y1": 1} if name in growths else {}, name)
        parts.append(row.select("place", name, change(name, "_y1").alias(f"{name}_growth_1y")) if name in growths else row)
    if brackets:
        every = None
        for k, df in enumerate(brackets, 1):
            row = latest(df, name=f"_b{k}")
            every = row if every is None else every.join(row, "place")
        total = sum((F.coalesce(f"_b{k}", F.lit(0.0)) for k in range(1, len(brackets) + 1)), F.lit(0.0))
        parts.append(every.select("place", total.alias("households"), *[F.when(total > 0, F.col(f"_b{k}") / total).alias(f"share_{k}") for k in range(1, len(brackets) + 1)]))
    if guests is not None:
        own = last_twelve(guests).select("place", F.col("now").alias("guests_12m"), F.col("growth").alias("guests_growth_1y"))
        if guests_local is not None:
            own = own.join(last_twelve(guests_local).select("place", F.col("now").alias("_l")), "place", "left").withColumn("guests_local_share", F.when(F.col("guests_12m") > 0, F.col("_l") / F.col("guests_12m"))).drop("_l")
        parts.append(own)
    out = outer(*parts)
    return out.withColumns({n: F.try_divide(F.col(a), F.col(b)) * 100 for n, (a, b) in (per_100 or {}).items()})


# countries


def compare_countries(nominal: DataFrame, prices: DataFrame, base_year: int = 2015, least: int = 10) -> DataFrame:
    """place, idx, real, nominal, real_1y, real_5y, from_peak, position, position_1y at the last quarter that two thirds of the places have.

    Growth since the base year; places without a whole base year or with fewer than
    20 quarters take no part; no rows under `least` places.
    """
    real = real_index(nominal, prices, base_year, True)
    real = lagged(lagged(real, 4, "r1"), 20, "r5").withColumn("top", F.max("value").over(ordered().rowsBetween(W.unboundedPreceding, 0)))
    ends = real.groupBy("place").agg(F.max("idx").alias("end"))
    n = ends.count()
    w = W.orderBy(F.desc("end"))
    # one row for each quarter in which a series ends
    common = ends.groupBy("end").agg(F.count("*").alias("c")).withColumn("c", F.sum("c").over(w)).where(F.col("c") >= n * 2 / 3).agg(F.max("end").alias("idx"))
    if n < least:
        common = common.limit(0)
    rows = real.join(common, "idx").join(nominal.select("place", "idx", F.col("value").alias("nom")), ["place", "idx"], "left")
    rows = rows.select("place", "idx", (F.col("value") / 100 - 1).alias("real"), (F.col("nom") / 100 - 1).alias("nominal"), change("value", "r1").alias("real_1y"), change("value", "r5").alias("real_5y"), change("value", "top").alias("from_peak"))
    place = lambda c: F.row_number().over(W.orderBy(F.col(c).desc_nulls_last(), "place"))  # noqa: E731  a few dozen countries
    return rows.withColumns({"position": place("real"), "position_1y": F.when(F.col("real_1y").isNotNull(), place("real_1y"))})


def demand(feats: DataFrame, premium: str) -> DataFrame:
    """n, median and share above 0 of a premium."""
    c = F.col(premium)
    return feats.where(c.isNotNull()).agg(F.count("*").alias("n"), F.percentile(c, 0.5).alias("median"), F.avg((c > 0).cast("double")).alias("share_positive"))


def volume_growth(feats: DataFrame, count: str, growth: str) -> DataFrame:
    """total, before, growth: the places' counts against what their growth implies for a year ago."""
    held = feats.where(F.col(count).isNotNull() & F.col(growth).isNotNull() & (F.col(growth) > -1))
    return held.agg(F.sum(count).alias("total"), F.sum(F.col(count) / (1 + F.col(growth))).alias("before")).withColumn("growth", change("total", "before"))
