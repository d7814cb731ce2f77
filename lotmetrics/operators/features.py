"""Features and scores of places. Frames are long: place, idx (a contiguous calendar key), value; one row a place and key."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .panel import band, ordered, pct_rank

#: Lags in quarters of the growth features.
GROWTH = {"1y": 4, "3y": 12, "5y": 20}


def latest(df: DataFrame, lags: dict[str, int] | None = None, name: str = "latest", key: str | None = None) -> DataFrame:
    """place, name and the lagged values at the globally last key; a place that misses it has nulls. One pass over df besides the key.

    key: a column for the last key, null where the value is.
    """
    last = df.agg(F.max("idx")).scalar()
    at = lambda k: F.max(F.when(F.col("idx") == last - k, F.col("value")))
    own = [] if key is None else [F.max(F.when((F.col("idx") == last) & F.col("value").isNotNull(), F.col("idx"))).alias(key)]
    return df.groupBy("place").agg(at(0).alias(name), *[at(k).alias(n) for n, k in (lags or {}).items()], *own)


def change(now, before) -> Column:
    return F.try_divide(F.col(now) if isinstance(now, str) else now, F.col(before) if isinstance(before, str) else before) - 1


def row_mean(*cols) -> Column:
    """The mean of the values that are not null; null if none is."""
    held = F.filter(F.array(*[F.col(c) if isinstance(c, str) else c for c in cols]), lambda x: x.isNotNull())
    return F.try_divide(F.aggregate(held, F.lit(0.0), lambda a, x: a + x), F.size(held))


def logistic(z: Column, scale: float = 1.0) -> Column:
    return 100 / (1 + F.exp(-z / scale))


def volatility(df: DataFrame, window: int = 12) -> DataFrame:
    """place and the standard deviation of log steps between neighbouring keys of the last window + 1 ones that occur anywhere."""
    keys = df.select("idx").distinct().withColumn("back", F.row_number().over(W.orderBy(F.desc("idx")))).where(F.col("back") <= window + 1)  # as many rows as the calendar has
    rows = df.where("value > 0").join(F.broadcast(keys), "idx")
    before = F.max("value").over(W.partitionBy("place").orderBy("back").rangeBetween(1, 1))
    steps = rows.withColumn("step", F.log("value") - F.log(before))
    return steps.groupBy("place").agg(F.stddev_samp("step").alias("volatility"), F.count("step").alias("steps"))


def shrunk(score: Column, volatile: Column) -> Column:
    """Scores of volatile places go half the way to 50."""
    return F.when(volatile, 50 + 0.5 * (score - 50)).otherwise(score)


def municipal_features(sales: DataFrame, rent: DataFrame | None = None, income: DataFrame | None = None, permits: DataFrame | None = None, completed: DataFrame | None = None, context: dict[str, DataFrame] | None = None) -> DataFrame:
    """A row for each place of sales: levels, growth, yields, valuation and supply scores, shrinkage of volatile places, band.

    sales is quarterly, all else yearly.  Percentiles compare the places with each
    other in one window: a cross-section has as many rows as there are places.
    """
    out = latest(sales, {f"p_{k}": n for k, n in GROWTH.items()}, "price")
    out = out.select("place", "price", *[change("price", f"p_{k}").alias(f"price_growth_{k}") for k in GROWTH])
    null = F.lit(None).cast("double")
    if rent is None:
        out = out.withColumns({"rent": null, "rent_growth_1y": null, "rent_year": F.lit(None).cast("bigint")})
    else:
        out = out.join(latest(rent, {"r_1y": 1}, "rent", "rent_year"), "place", "left").withColumn("rent_growth_1y", change("rent", "r_1y")).drop("r_1y")
    out = out.withColumns({"gross_yield": F.try_divide(F.col("rent") * 12, "price"), "price_to_rent_years": F.try_divide("price", F.col("rent") * 12)})
    out = out.withColumns({"income": null, "income_year": F.lit(None).cast("bigint")}) if income is None else out.join(latest(income, name="income", key="income_year"), "place", "left")
    out = out.withColumns({"price_to_income_months": F.try_divide("price", "income"), "rent_to_income": F.try_divide("rent", "income")})
    for name, df in (context or {}).items():
        out = out.join(latest(df, name=name), "place", "left")
    parts = {"score_part_g1y": pct_rank(F.col("price_growth_1y")), "score_part_g3y": pct_rank(F.col("price_growth_3y")), "score_part_yield": 100 - pct_rank(F.col("gross_yield"))}
    supply = []
    for name, df in (("permits", permits), ("completed", completed)):
        if df is not None:
            out = out.join(latest(df, {"_prev": 3}, name), "place", "left").withColumn(f"{name}_growth", change(name, "_prev")).drop("_prev")
            parts[f"_{name}"] = 100 - pct_rank(F.col(f"{name}_growth"))
            supply.append(f"_{name}")
    out = out.withColumns(parts)
    out = out.withColumns({"score_valuation": row_mean("score_part_g1y", "score_part_g3y", "score_part_yield"), "score_supply": row_mean(*supply) if supply else null}).drop(*supply)
    out = out.join(volatility(sales).drop("steps"), "place", "left")
    every = W.partitionBy(F.lit(1))
    limit = F.when(F.count("volatility").over(every) >= 10, F.percentile("volatility", 0.9).over(every))
    out = out.withColumn("volatile", F.coalesce(F.col("volatility") >= limit, F.lit(False)))
    out = out.withColumn("score_overall", shrunk(row_mean("score_valuation", "score_supply"), F.col("volatile")))
    return out.withColumn("band", band(F.col("score_overall")))


def real_growth(feats: DataFrame, sales: DataFrame, prices: DataFrame) -> DataFrame:
    """feats with price_growth_*_real: less inflation over a span of the same length that ends at the last published price level.

    prices: idx, value of one deflator.
    """
    known = prices.where("value is not null")
    end = F.broadcast(known.agg(F.max("idx").alias("h")).crossJoin(sales.agg(F.max("idx").alias("s"))).select(F.least("h", "s").alias("end")))  # one row
    at = lambda back: F.max_by("value", F.when(F.col("idx") <= F.col("end") - back, F.col("idx")))
    level = known.crossJoin(end).agg(*[F.try_divide(at(0), at(n)).alias(f"_i{k}") for k, n in GROWTH.items()])
    rows = feats.crossJoin(F.broadcast(level))
    return rows.select(*feats.columns, *[(F.try_divide(1 + F.col(f"price_growth_{k}"), F.col(f"_i{k}")) - 1).alias(f"price_growth_{k}_real") for k in GROWTH])


def outer(*frames: DataFrame | None) -> DataFrame:
    """Frames by place, all places kept."""
    out = None
    for df in frames:
        if df is not None:
            out = df if out is None else out.join(df, "place", "full_outer")
    return out


def three_months(valuation: DataFrame, name: str) -> DataFrame:
    """The mean of the last three months against those a year before, each over the months that are there."""
    rows = latest(valuation, {"m1": 1, "m2": 2, "y0": 12, "y1": 13, "y2": 14})
    now = row_mean("latest", "m1", "m2")
    return rows.select("place", now.alias(name), change(now, row_mean("y0", "y1", "y2")).alias(f"{name}_growth_1y"))


def extra_features(quarterly: dict[str, DataFrame], valuations: dict[str, DataFrame], counts: dict[str, DataFrame], yearly: dict[str, DataFrame], premiums: dict[str, tuple[str, str]], contracts: DataFrame | None = None) -> DataFrame:
    """Context features by place, outer-joined: latest levels, premiums (name: over, under), three-month valuations, counts with their growth, yearly levels with their year."""
    last = lambda df: df.agg(F.max("idx")).scalar()
    parts = [latest(df, name=n) for n, df in quarterly.items()] + [three_months(df, n) for n, df in valuations.items()]
    parts += [latest(df, {"y0": 12}, n).select("place", n, change(n, "y0").alias(f"{n}_growth_1y")) for n, df in counts.items()]
    parts += [latest(df, name=n).withColumn(f"{n}_year", last(df)) for n, df in yearly.items()]
    if contracts is not None:
        parts.append(latest(contracts, {"prev": 1}, "contracts").select("place", "contracts", change("contracts", "prev").alias("contracts_growth"), last(contracts).alias("contracts_year")))
    out = outer(*parts)
    return out.withColumns({n: change(a, b) for n, (a, b) in premiums.items()})


# one series a place: national scores


def positional_change(n: int, ratio: bool = True) -> Column:
    before = F.lag("value", n).over(ordered())
    return F.try_divide(F.col("value"), before) - 1 if ratio else F.col("value") - before


def last_z(column: str, frame: W, least: int = 8) -> Column:
    """z of the frame's last known value against all of the frame, from `least` of them on."""
    sd = F.stddev_samp(column).over(frame)
    return F.when((F.count(column).over(frame) >= least) & (sd != 0), (F.last(column, True).over(frame) - F.avg(column).over(frame)) / sd)


def trend_z(log_value: str, position: str, frame: W, least: int = 12) -> Column:
    """The last residual of a straight line through log values by position, in standard deviations of the residuals."""
    y, x = F.col(log_value), F.col(position)
    n, sxx, syy, sxy = F.count(y).over(frame), F.regr_sxx(y, x).over(frame), F.regr_syy(y, x).over(frame), F.regr_sxy(y, x).over(frame)
    slope = sxy / sxx
    rest = F.last(y, True).over(frame) - F.avg(y).over(frame) - slope * (F.last(F.when(y.isNotNull(), x), True).over(frame) - F.avg(F.when(y.isNotNull(), x)).over(frame))
    # rounding makes the residuals of an exact line a little more than nothing
    spread = F.greatest(syy - slope * sxy, F.lit(0.0))
    return F.when((n >= least) & (spread > 1e-18), rest / F.sqrt(spread / (n - 1)))


def running() -> W:
    return ordered().rowsBetween(W.unboundedPreceding, 0)


def national_components(index: DataFrame, rates: DataFrame | None = None, credit: DataFrame | None = None) -> DataFrame:
    """place, idx, component, value, z: each component as known at each key (index, credit: quarters; rates: months).

    Growth over four rows and the distance from the trend need 20 rows of the index,
    the change of rates over twelve rows 24, the credit gap 8.
    """
    w = running()
    n = F.count(F.lit(1)).over(w)
    index = index.withColumns({"_g": positional_change(4), "_l": F.when(F.col("value") > 0, F.log("value")), "_x": F.row_number().over(ordered()).cast("double")})
    made = lambda name, value, z: F.struct(F.lit(name).alias("component"), value.alias("value"), z.alias("z"))
    trend = trend_z("_l", "_x", w)
    index = index.withColumns({"_n": n, "_v": F.last("_g", True).over(w), "_z": last_z("_g", w), "_t": trend})
    out = index.where("_n >= 20").select("place", "idx", F.inline(F.array(made("growth", F.col("_v"), F.col("_z")), made("trend", F.col("_t"), F.col("_t")))))
    if rates is not None:
        rates = rates.withColumn("_g", positional_change(12, False)).withColumns({"_n": n})
        out = out.unionByName(rates.where("_n >= 1").select("place", "idx", F.lit("rates").alias("component"), F.last("_g", True).over(w).alias("value"), last_z("_g", w).alias("z"), "_n").where("_n >= 24").drop("_n"))
    if credit is not None:
        out = out.unionByName(credit.withColumn("_n", n).select("place", "idx", F.lit("credit").alias("component"), "value", last_z("value", w).alias("z"), "_n").where("_n >= 8").drop("_n"))
    return out


def national_scores(index: DataFrame, rates: DataFrame | None = None, credit: DataFrame | None = None) -> DataFrame:
    """place, components (map of name to struct<value,z,score>), overall, band, as of the end of each series."""
    rows = national_components(index, rates, credit)
    last = F.row_number().over(W.partitionBy("place", "component").orderBy(F.desc("idx")))
    rows = rows.withColumn("_k", last).where("_k = 1").withColumn("score", logistic(F.col("z")))
    out = rows.groupBy("place").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("component", F.struct("value", "z", "score"))))).alias("components"), F.avg("score").alias("overall"))
    return out.withColumn("band", open_band(F.col("overall")))


def open_band(score: Column) -> Column:
    """Bands that begin at 40 and 70."""
    return F.when(score < 40, "green").when(score < 70, "amber").when(score.isNotNull(), "red")


# change between quarters


def quarter_changes(sales: DataFrame, rent: DataFrame | None = None) -> DataFrame:
    """place, price, price_prev, qoq, score, score_prev, dscore, band, band_prev, moved (1 up, -1 down, 0), volatile.

    The features of the last quarter against those that the data without it give;
    empty if the quarter before has no data.
    """
    last = sales.agg(F.max("idx")).scalar()
    before = sales.where(F.col("idx") < last)
    pick = lambda df, end: df.select("place", F.col("price").alias(f"price{end}"), F.col("score_overall").alias(f"score{end}"), F.col("band").alias(f"band{end}"), *([] if end else ["volatile"]))
    now, then = pick(municipal_features(sales, rent), ""), pick(municipal_features(before, rent), "_prev")
    rows = now.join(then, "place", "left").where(before.agg(F.max("idx")).scalar() == last - 1)
    order = lambda c: F.when(F.col(c) == "green", 0).when(F.col(c) == "amber", 1).when(F.col(c) == "red", 2)
    return rows.withColumns({"qoq": change("price", "price_prev"), "dscore": F.col("score") - F.col("score_prev"), "moved": F.signum(order("band") - order("band_prev")).cast("int")})


def change_summary(changes: DataFrame) -> DataFrame:
    """One row: places, median step, share up, bands up and down, reds now and before."""
    q = F.col("qoq")
    return changes.agg(
        F.count(q).alias("n"), F.percentile(q, 0.5).alias("median_qoq"), F.avg(F.when(q.isNotNull(), (q > 0).cast("double"))).alias("share_up"), F.count_if(F.col("moved") > 0).alias("band_up"), F.count_if(F.col("moved") < 0).alias("band_down"),
        F.count_if(F.col("band") == "red").alias("red"), F.count_if(F.col("band_prev") == "red").alias("red_prev"),
    )


def total_return(price: DataFrame, real: DataFrame, rent: DataFrame, years: int = 5, costs: float = 0.25) -> DataFrame:
    """place, price_real, inflation, yield_net, total, rent_years: real price growth a year plus the mean yield after costs.

    price, real: quarters; rent: years. Needs both ends of the span and three years of rents.
    """
    held = real.where("value is not null").select("place", "idx", F.col("value").alias("real")).join(price.where("value is not null"), ["place", "idx"], "left")
    end = F.max("idx").over(W.partitionBy("place"))
    ends = held.withColumn("end", end).where((F.col("idx") == F.col("end")) | (F.col("idx") == F.col("end") - 4 * years))
    at = lambda c, k: F.max(F.when(F.col("idx") == F.col("end") - k, F.col(c)))
    ends = ends.groupBy("place", "end").agg(*[at(c, k).alias(n) for n, c, k in (("r1", "real", 0), ("r0", "real", 4 * years), ("p1", "value", 0), ("p0", "value", 4 * years))]).where("r0 > 0 and p0 is not null and p1 is not null")
    a_year = price.where("value is not null").groupBy("place", F.floor(F.col("idx") / 4).alias("year")).agg(F.avg("value").alias("level"))
    yields = rent.where("value is not null").select("place", F.col("idx").alias("year"), F.col("value").alias("rent")).join(a_year, ["place", "year"]).join(ends, "place")
    yields = yields.where(F.col("year").between(F.floor((F.col("end") - 4 * years) / 4), F.floor(F.col("end") / 4)))
    yields = yields.groupBy("place").agg(F.avg(F.try_divide(F.col("rent") * 12, "level")).alias("gross"), F.count("*").alias("rent_years")).where("rent_years >= 3")
    a = lambda c: F.pow(c, F.lit(1 / years)) - 1
    rows = ends.join(yields, "place").withColumns({"price_real": a(F.col("r1") / F.col("r0")), "inflation": a((F.col("p1") / F.col("r1")) / (F.col("p0") / F.col("r0"))), "yield_net": F.col("gross") * (1 - costs)})
    return rows.select("place", "price_real", "inflation", "yield_net", (F.col("price_real") + F.col("yield_net")).alias("total"), "rent_years")


