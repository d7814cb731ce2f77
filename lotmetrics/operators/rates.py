"""Rate effects and the age of series."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import keys
from ..functions.finance import capacity, instalment
from .panel import lagged, ordered

#: Months after which a series of each kind is stale; the spread where no mortgage rate is known.
LIMITS, SPREAD = {"month": 4, "quarter": 9, "year": 30}, 1.0


def passthrough(market: DataFrame, mortgage: DataFrame, months: int = 36, least: int = 24) -> DataFrame:
    """place, slope: how much of a month's change of the market rate the mortgage rate takes over, between 0 and 1.5, from the last `months` monthly steps.

    market, mortgage: place (a country), idx, value.
    """
    both = market.select("place", "idx", F.col("value").alias("e")).join(mortgage.select("place", "idx", F.col("value").alias("m")), ["place", "idx"]).where("e is not null and m is not null")
    steps = lagged(lagged(both, 1, "_e", "e"), 1, "_m", "m").select("place", "idx", (F.col("e") - F.col("_e")).alias("de"), (F.col("m") - F.col("_m")).alias("dm")).where("de is not null and dm is not null")
    recent = steps.withColumn("_k", F.row_number().over(W.partitionBy("place").orderBy(F.desc("idx")))).where(F.col("_k") <= months)
    out = recent.groupBy("place").agg(F.count("*").alias("n"), F.var_samp("de").alias("v"), F.regr_slope("dm", "de").alias("slope")).where((F.col("n") >= least) & (F.col("v") > 0))
    return out.select("place", F.least(F.greatest("slope", F.lit(0.0)), F.lit(1.5)).alias("slope"))


def rate_now(market: DataFrame, mortgage: DataFrame) -> DataFrame:
    """place, market, spread, slope, rate: today's mortgage rate in percent, the last one carried on with the market's change since.

    The spread at the last mortgage rate counts if it is between 0 and 4, else the
    assumed one; without a slope the rate is the market's plus the spread.
    """
    last = lambda df, v: df.where("value is not null").groupBy("place").agg(F.max_by("value", "idx").alias(v), F.max("idx").alias(f"{v}_at"))
    rows = last(market, "market").join(last(mortgage, "mortgage"), "place", "left").join(passthrough(market, mortgage), "place", "left")
    then = market.select("place", F.col("idx").alias("mortgage_at"), F.col("value").alias("then"))
    rows = rows.join(then, ["place", "mortgage_at"], "left").withColumn("seen", F.col("mortgage") - F.col("then"))
    known = F.col("seen").between(0, 4)
    spread = F.when(known, F.col("seen")).otherwise(SPREAD)
    slope = F.when(known, F.col("slope"))
    return rows.select("place", "market", spread.alias("spread"), slope.alias("slope"), F.coalesce(F.col("mortgage") + slope * (F.col("market") - F.col("then")), F.col("market") + spread).alias("rate"))


def shock_effects(rates: DataFrame, shocks: tuple[float, ...] = (-1.0, 1.0), years: int = 30) -> DataFrame:
    """place, shock, instalment, capacity: the changes of a loan's payment, and of the loan that a payment carries, by a shift of the rate."""
    one, y = F.lit(1.0), F.lit(float(years))
    rows = rates.select("place", "rate", F.explode(F.array(*map(F.lit, shocks))).alias("shock"))
    after = F.greatest(F.col("rate") + F.col("shock"), F.lit(0.0))
    return rows.select("place", "shock", (instalment(one, after, y) / instalment(one, F.col("rate"), y) - 1).alias("instalment"), (capacity(one, after, y) / capacity(one, F.col("rate"), y) - 1).alias("capacity"))


def rate_changes(index: DataFrame, market: DataFrame, ahead: int = 4) -> DataFrame:
    """place, idx, y, d, m: the log change of an index (place, idx by quarter, value) over the next `ahead` quarters, the change of
    the market rate (place, idx by month, value; quarterly means) over the same quarters, and the index's log change before."""
    log = index.where("value > 0").select("place", "idx", F.log("value").alias("value"))
    log = lagged(lagged(log, -ahead, "_next"), ahead, "_before")
    rate = market.groupBy("place", F.floor(F.col("idx") / 3).cast("bigint").alias("idx")).agg(F.avg("value").alias("value"))
    rate = lagged(rate, -ahead, "_then").select("place", "idx", (F.col("_then") - F.col("value")).alias("d"))
    rows = log.join(rate, ["place", "idx"]).select("place", "idx", (F.col("_next") - F.col("value")).alias("y"), "d", (F.col("value") - F.col("_before")).alias("m"))
    return rows.where("y is not null and d is not null and m is not null")


#: The sums from which the slope of y on d, beside m, follows.
PARTS = {"s_n": "1e0", "s_y": "y", "s_d": "d", "s_m": "m", "s_dd": "d * d", "s_mm": "m * m", "s_dm": "d * m", "s_yd": "y * d", "s_ym": "y * m"}


def slope_beside() -> Column:
    """The least-squares slope of y on d with m and a constant beside it, from PARTS; null where it is not determined."""
    spread = lambda a, b, both: F.col(f"s_{both}") - F.col(f"s_{a}") * F.col(f"s_{b}") / F.col("s_n")
    dd, mm, dm = spread("d", "d", "dd"), spread("m", "m", "mm"), spread("d", "m", "dm")
    return F.when(F.col("s_n") > 0, F.try_divide(spread("y", "d", "yd") * mm - spread("y", "m", "ym") * dm, dd * mm - dm * dm))


def drawn(of: Column) -> Column:
    """A number from 0 to 2^32 - 1 that a text's digest gives: equal in every run, and in SQL."""
    return F.conv(F.substring(F.md5(of), 1, 8), 16, 10).cast("bigint")


def rate_effect(changes: DataFrame, draws: int = 1000, block: int = 8, least: int = 24) -> DataFrame:
    """place, n, beta, low, high, credible: the effect of one point of the rate on the index, with 90 % bounds by a moving-block bootstrap.

    changes: as of rate_changes; places with fewer than `least` rows are absent.  A draw
    puts blocks of consecutive rows on end until it has as many rows as the series, the
    last block cut.  Blocks are not expanded to rows: every block's sums are made once,
    and a draw adds the sums of its blocks, so a place costs draws * n / block rows.
    Starts come from a digest of draw and block.  An effect is credible if even the
    upper bound is below 0.
    """
    if not 1 <= block <= least:
        raise ValueError("block is between 1 and least")
    own, every = W.partitionBy("place").orderBy("idx"), W.partitionBy("place")
    rows = changes.withColumns({"t": F.row_number().over(own) - 1, "n": F.count("*").over(every)}).where(F.col("n") >= least)
    # sums of centred numbers lose no digits
    rows = rows.select("place", "t", "n", *[(F.col(c) - F.avg(c).over(every)).alias(c) for c in ("y", "d", "m")])
    blocks = F.ceil(F.col("n") / block).cast("int")
    rest = (F.col("n") - (blocks - 1) * block).cast("int")
    sums = [F.sum(F.expr(e)).alias(k) for k, e in PARTS.items()]
    full = rows.groupBy("place", "n").agg(*sums).select("place", "n", slope_beside().alias("beta"))
    begins = F.sequence(F.greatest(F.lit(0), F.col("t") - F.col("size") + 1).cast("int"), F.least(F.col("t"), F.col("n") - block).cast("int"))
    sized = rows.withColumn("size", F.explode(F.array_distinct(F.array(F.lit(block), rest)))).where(F.col("t") - F.col("size") + 1 <= F.col("n") - block)
    partial = sized.withColumn("begin", F.explode(begins)).groupBy("place", "size", "begin").agg(*sums)
    turns = full.select("place", "n", F.explode(F.sequence(F.lit(0), F.lit(draws - 1))).alias("draw")).withColumn("turn", F.explode(F.sequence(F.lit(0), blocks - 1)))
    size = F.when(F.col("turn") == blocks - 1, rest).otherwise(F.lit(block))
    begin = F.pmod(drawn(F.concat_ws(":", F.col("draw").cast("string"), F.col("turn").cast("string"))), F.col("n") - block + 1).cast("int")
    taken = turns.select("place", "draw", size.alias("size"), begin.alias("begin")).join(partial, ["place", "size", "begin"])
    slopes = taken.groupBy("place", "draw").agg(*[F.sum(c).alias(c) for c in PARTS]).select("place", slope_beside().alias("b"))
    bounds = slopes.groupBy("place").agg(F.percentile("b", [0.05, 0.95]).alias("q")).select("place", F.col("q")[0].alias("low"), F.col("q")[1].alias("high"))
    return full.join(bounds, "place", "left").select("place", "n", "beta", "low", "high", F.coalesce(F.col("high") < 0, F.lit(False)).alias("credible"))


def price_effects(effects: DataFrame, shocks: tuple[float, ...] = (-1.0, 1.0)) -> DataFrame:
    """place, shock, price_effect, low, high: the change of the index a year after a shift of the rate by `shock` points, where the effect is credible."""
    rows = effects.where("credible").withColumn("shock", F.explode(F.array(*map(F.lit, shocks))))
    change = lambda c: F.exp(F.col(c) * F.col("shock")) - 1
    return rows.select("place", "shock", change("beta").alias("price_effect"), F.least(change("low"), change("high")).alias("low"), F.greatest(change("low"), change("high")).alias("high"))


def age_in_months(label: Column, today: Column) -> Column:
    day = keys.period_end(label)["day"]
    return (F.year(today) - F.year(day)) * 12 + F.month(today) - F.month(day)


def stale_series(last: DataFrame, specs: DataFrame, today: Column) -> DataFrame:
    """source, key, last, months, limit of the series older than their limit, the worst first by months over limit.

    last: source, key, last (a period label); specs: source, key, max_months (null:
    the kind's limit), static (never stale).
    """
    kind = keys.period_end(F.col("last"))["kind"]
    usual = F.coalesce(*[F.when(kind == k, F.lit(v)) for k, v in LIMITS.items()])
    rows = last.join(specs, ["source", "key"]).where(~F.coalesce("static", F.lit(False)))
    rows = rows.select("source", "key", "last", age_in_months(F.col("last"), today).alias("months"), F.coalesce("max_months", usual).alias("limit")).where(F.col("months") > F.col("limit"))
    return rows.withColumn("position", F.row_number().over(W.orderBy(F.desc(F.col("months") / F.col("limit")), "source", "key")))


def drift(df: DataFrame, steps: int) -> DataFrame:
    """place, value: the last ln value carried on with the mean step of its history, for `steps` keys."""
    rows = df.where("value is not null").withColumn("_d", F.col("value") - F.lag("value").over(ordered()))
    return rows.groupBy("place").agg((F.max_by("value", "idx") + steps * F.avg("_d")).alias("value"))
