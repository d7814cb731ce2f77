"""Candidate signals of the price forecast, each as known at the end of a quarter. Tests of them: models.signal_tests."""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .panel import asof, lagged

#: Months of a loan, the month of a year (from 0) from which the year before is published.
TERM, PUBLISHED = 360, 6


def last_month(idx):
    """The last month of a quarter."""
    return idx * 3 + 2


def yearly_change(series: DataFrame, quarters: DataFrame, name: str, total: bool = False) -> DataFrame:
    """idx, name: for each quarter the log change of one national monthly series (idx, value) within a year, of the values last known.

    total: of the sum of twelve months, all of which must be there. Values up to 0 do not count.
    """
    w = W.partitionBy("place").orderBy("idx").rangeBetween(-11, 0)
    rows = series.select(F.lit(0).alias("place"), "idx", F.col("value").cast("double").alias("value"))
    if total:
        rows = rows.withColumn("value", F.when(F.count("value").over(w) == 12, F.sum("value").over(w)))
    rows = rows.where("value > 0").withColumn("value", F.log("value"))
    at = quarters.select("idx").distinct().select(F.lit(0).alias("place"), F.col("idx").alias("_q"), last_month(F.col("idx")).alias("idx"))
    now = asof(at, rows, "value", "_now")
    then = asof(now.withColumn("idx", F.col("idx") - 12), rows, "value", "_then")
    return then.select(F.col("_q").alias("idx"), (F.col("_now") - F.col("_then")).alias(name))


def valuation_gap(sales: DataFrame, valuation: DataFrame, name: str) -> DataFrame:
    """place, idx, name: the log valuation of a quarter's last month less the log price. sales by quarter, valuation by month; both ln."""
    then = valuation.where("idx % 3 = 2").select("place", F.floor(F.col("idx") / 3).cast("bigint").alias("idx"), F.col("value").alias("_v"))
    return sales.join(then, ["place", "idx"], "left").select("place", "idx", (F.col("_v") - F.col("value")).alias(name))


def published_change(yearly: DataFrame, quarters: DataFrame, name: str) -> DataFrame:
    """place, idx, name: the log change of the last year that was published by the end of a quarter (place, idx), of yearly values (place, idx, value)."""
    rows = lagged(yearly.where("value > 0").withColumn("value", F.log("value")), 1, "_before").select("place", F.col("idx").alias("_y"), (F.col("value") - F.col("_before")).alias(name))
    month = last_month(F.col("idx"))
    year = F.floor(month / 12) - F.when(month % 12 >= PUBLISHED, 1).otherwise(2)
    return quarters.select("place", "idx").withColumn("_y", year.cast("bigint")).join(rows, ["place", "_y"], "left").select("place", "idx", name)


def purchase_effort(sales: DataFrame, rate: DataFrame, income: DataFrame, name: str) -> DataFrame:
    """place, idx, name: log of a loan's payment over income: sales ln by quarter, rate (idx, value) in percent by month, income by year, two years late.

    The last year of anyone's income that was known counts for all; a place without it has null.
    """
    at = sales.select("idx").distinct().select(F.lit(0).alias("place"), F.col("idx").alias("_q"), last_month(F.col("idx")).alias("idx"))
    monthly = asof(at, rate.select(F.lit(0).alias("place"), "idx", "value"), "value", "_r").select("_q", (F.col("_r") / 1200).alias("_r"))
    years = income.where("value > 0").select(F.lit(0).alias("place"), "idx").distinct().withColumn("_y", F.col("idx"))
    known = asof(at.withColumn("idx", (F.floor(F.col("idx") / 12) - 2).cast("bigint")), years, "_y", "_y").select(F.col("_q").alias("_p"), "_y")
    of = income.where("value > 0").select("place", F.col("idx").alias("_y"), F.log("value").alias("_i"))
    r = F.col("_r")
    factor = F.when(r > 1e-9, r / (1 - F.pow(1 + r, F.lit(-TERM)))).otherwise(F.lit(1 / TERM))
    rows = sales.join(monthly, F.col("idx") == F.col("_q")).join(known, F.col("idx") == F.col("_p")).join(of, ["place", "_y"], "left")
    return rows.select("place", "idx", (F.col("value") + F.when(r.isNotNull(), F.log(factor)) - F.col("_i")).alias(name))


def candidates(quarters: DataFrame, signals: dict[str, DataFrame]) -> DataFrame:
    """place, idx and a column a signal (place, idx, name, or idx, name for national ones); a place that lacks it has the median of its quarter."""
    out = quarters.select("place", "idx")
    for name, df in signals.items():
        out = out.join(df, [c for c in ("place", "idx") if c in df.columns], "left")
    middle = out.groupBy("idx").agg(*[F.percentile(n, 0.5).alias(f"_{n}") for n in signals])
    return out.join(middle, "idx").select("place", "idx", *[F.coalesce(n, f"_{n}").alias(n) for n in signals])
