"""Index construction, resampling and gap filling on long frames (place, idx, value)."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .panel import ordered

#: Sub-periods of a year by kind.
STEPS = {"year": 1, "quarter": 4, "month": 12}


def resampled(df: DataFrame, per: int, how: str = "mean", least: int | None = None) -> DataFrame:
    """Blocks of `per` keys as one: mean or sum of those with `least` values (all of them by default)."""
    value = F.sum("value") if how == "sum" else F.avg("value")
    rows = df.groupBy("place", F.floor(F.col("idx") / per).cast("bigint").alias("_i")).agg(value.alias("value"), F.count("value").alias("_n"))
    return rows.where(F.col("_n") >= (per if least is None else least)).select("place", F.col("_i").alias("idx"), "value")


def monthly_to_quarterly(df: DataFrame, least: int = 3) -> DataFrame:
    return resampled(df, 3, "mean", least)


def to_annual(df: DataFrame, kind: str, how: str = "sum") -> DataFrame:
    """Complete years only; yearly frames stay."""
    return df.select("place", "idx", "value") if kind == "year" else resampled(df, STEPS[kind], how)


def last_twelve(df: DataFrame) -> DataFrame:
    """place, now, growth: the last twelve months of the whole frame against the twelve before; both must be complete, the first for a row."""
    end = df.agg(F.max("idx")).scalar()
    back = end - F.col("idx")
    now, before = F.when(back < 12, F.col("value")), F.when((back >= 12) & (back < 24), F.col("value"))
    rows = df.groupBy("place").agg(F.sum(now).alias("now"), F.count(now).alias("n"), F.sum(before).alias("before"), F.count(before).alias("m")).where("n = 12")
    return rows.select("place", "now", F.when((F.col("m") == 12) & (F.col("before") > 0), F.col("now") / F.col("before") - 1).alias("growth"))


def chained(*frames: DataFrame) -> DataFrame:
    """The first frame, continued by each next one after its end, scaled by the mean ratio over the keys that both have.

    A frame without a common key adds nothing.
    """
    out = frames[0].select("place", "idx", "value")
    for df in frames[1:]:
        new = df.select("place", "idx", F.col("value").alias("new"))
        both = out.join(new, ["place", "idx"], "full_outer")
        w = W.partitionBy("place")
        ratio = F.avg(F.when(F.col("new") != 0, F.col("value") / F.col("new"))).over(w)
        end = F.max(F.when(F.col("value").isNotNull(), F.col("idx"))).over(w)
        both = both.select("place", "idx", F.coalesce("value", F.when(F.col("idx") > end, F.col("new") * ratio)).alias("value"))
        out = both.where("value is not null")
    return out


def extended_by_rates(index: DataFrame, rates: DataFrame) -> DataFrame:
    """A monthly index carried past its end by yearly rates in percent: value twelve months before times 1 + rate.

    A month's value is the last known one of its calendar month times the product
    of the rates since; the first month that lacks one ends the series.
    """
    known = index.where("value is not null")
    end = known.groupBy("place").agg(F.max("idx").alias("end"))
    later = rates.where("value is not null").join(end, "place").where(F.col("idx") > F.col("end")).select("place", "idx", F.col("value").alias("rate"), "end")
    back = F.ceil((F.col("idx") - F.col("end")) / 12) * 12
    later = later.withColumns({"_base": F.col("idx") - back})
    base = known.select("place", F.col("idx").alias("_base"), F.col("value").alias("_from"))
    later = later.join(base, ["place", "_base"], "left")
    # a base has few rates, one a year; a rate of -100 % or less makes the index 0 or turns its sign
    so_far = F.collect_list(1 + F.col("rate") / 100).over(W.partitionBy("place", "_base").orderBy("idx").rowsBetween(W.unboundedPreceding, 0))
    product = F.aggregate(so_far, F.lit(1.0), lambda a, x: a * x)
    missing = F.max(F.when(F.col("_from").isNull(), 1).otherwise(0)).over(ordered().rowsBetween(W.unboundedPreceding, 0))
    later = later.withColumns({"_p": product, "_stop": F.greatest(missing, stop_after_gap())})
    return known.select("place", "idx", "value").unionByName(later.where("_stop = 0").select("place", "idx", (F.col("_from") * F.col("_p")).alias("value")))


def stop_after_gap() -> Column:
    """1 from the first row on whose value twelve keys before would be one that the series lacks.

    That row is the first whose key twelve before lies behind the end in a gap of
    the rates.
    """
    back = F.col("idx") - 12
    held = F.max(F.lit(1)).over(ordered().rangeBetween(-12, -12))
    lacks = (back > F.col("end")) & held.isNull()
    return F.coalesce(F.max(F.when(lacks, 1).otherwise(0)).over(ordered().rowsBetween(W.unboundedPreceding, 0)), F.lit(0))


def real_index(nominal: DataFrame, prices: DataFrame, base_year: int = 2015, strict: bool = False, least: int = 20) -> DataFrame:
    """Quarterly nominal over prices times 100, the base year's mean at 100 where its four quarters are there.

    strict: places without a whole base year or with fewer than `least` quarters go.
    """
    rows = nominal.join(prices.select("place", "idx", F.col("value").alias("_p")), ["place", "idx"]).select("place", "idx", (F.try_divide("value", "_p") * 100).alias("value")).where("value is not null")
    w = W.partitionBy("place")
    base = F.when(F.col("idx").between(base_year * 4, base_year * 4 + 3), F.col("value"))
    rows = rows.withColumns({"_n": F.count(base).over(w), "_m": F.avg(base).over(w), "_all": F.count("*").over(w)})
    if strict:
        rows = rows.where((F.col("_n") == 4) & (F.col("_all") >= least))
    return rows.select("place", "idx", F.when(F.col("_n") == 4, F.col("value") * 100 / F.col("_m")).otherwise(F.col("value")).alias("value"))


def log_grid(df: DataFrame) -> DataFrame:
    """Every place at every key from the first to the last one that occurs, with ln(value); null where there is none above 0."""
    held = df.where("value > 0")
    span = F.broadcast(held.agg(F.min("idx").alias("a"), F.max("idx").alias("b")).where("a is not null"))  # one row
    grid = held.select("place").distinct().crossJoin(span).select("place", F.explode(F.sequence("a", "b")).alias("idx"))
    return grid.join(held.select("place", "idx", F.log("value").alias("value")), ["place", "idx"], "left")


def rolling_log(df: DataFrame, n: int = 3, least: int = 2) -> DataFrame:
    """ln of the mean of the last n keys of a dense grid with `least` values."""
    grid = log_grid(df).withColumn("_v", F.exp("value"))
    w = ordered().rowsBetween(1 - n, 0)
    return grid.select("place", "idx", F.when(F.count("_v").over(w) >= least, F.log(F.avg("_v").over(w))).alias("value"))


def filled(df: DataFrame, most: int) -> DataFrame:
    """The last known value at keys without one, at most `most` keys on; a dense grid is needed."""
    return df.withColumn("value", F.coalesce("value", F.last("value", True).over(ordered().rowsBetween(-most, 0))))


def rolling_total(df: DataFrame, n: int = 12) -> DataFrame:
    """Sums of n keys that are all there."""
    w = ordered().rangeBetween(1 - n, 0)
    return df.select("place", "idx", F.when(F.count("value").over(w) == n, F.sum("value").over(w)).alias("value")).where("value is not null")


def window_mean(df: DataFrame, quarters: DataFrame, months: int = 12, least: int = 9) -> DataFrame:
    """place, idx (of quarters: place, idx), mean: of the months that end with the quarter's last one, with `least` of them.

    Each month goes to the four quarters whose window holds it: an equi-join, no range join.
    """
    own = F.floor(F.col("idx") / 3)
    rows = df.where("value is not null").select("place", "value", F.explode(F.sequence(own, own + months // 3 - 1)).alias("idx"))
    means = rows.groupBy("place", "idx").agg(F.avg("value").alias("mean"), F.count("*").alias("n")).where(F.col("n") >= least).drop("n")
    return quarters.select("place", "idx").join(means, ["place", "idx"])


def latest_per_key(df: DataFrame, order: str) -> DataFrame:
    """One row a place and key: the last by `order`."""
    return df.groupBy("place", "idx").agg(F.max_by("value", order).alias("value"))


def upserted(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """new, and the rows of old whose key new lacks."""
    return new.unionByName(old.join(new.select(key).distinct(), key, "left_anti").select(*new.columns))
