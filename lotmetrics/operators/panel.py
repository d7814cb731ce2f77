"""Relational operators on long panels: (place, idx, value), idx a contiguous calendar key."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .storage import stored


def ordered(place: str = "place", idx: str = "idx") -> W:
    return W.partitionBy(place).orderBy(idx)


def lagged(df: DataFrame, lag: int, out: str, value: str = "value", place: str = "place", idx: str = "idx") -> DataFrame:
    """The value `lag` calendar keys before; null where that key is missing. One range window, no self-join."""
    w = W.partitionBy(place).orderBy(idx).rangeBetween(-lag, -lag)
    return df.withColumn(out, F.max(value).over(w))


def latest_with_lags(df: DataFrame, lags: dict[str, int]) -> DataFrame:
    """Rows of the globally last key with their lagged values; places that miss it are absent."""
    for out, lag in lags.items():
        df = lagged(df, lag, out)
    last = df.agg(F.max("idx")).scalar()
    return df.where(F.col("idx") == last)


def pct_rank(value: Column, by: list[Column] | None = None) -> Column:
    """100 * average rank / count of non-nulls; null stays null."""
    group = by or [F.lit(1)]
    w = W.partitionBy(*group, value.isNull()).orderBy(value)
    ties = F.count(F.lit(1)).over(W.partitionBy(*group, value))
    return F.when(value.isNotNull(), 100 * (F.rank().over(w) + (ties - 1) / 2) / F.count(value).over(W.partitionBy(*group, value.isNull())))


def band(score: Column) -> Column:
    """Right-closed bands at 40 and 70."""
    return F.when(score <= 40, "green").when(score <= 70, "amber").when(score.isNotNull(), "red")


def rolling_sum(value: str, n: int) -> Column:
    """Sum of n consecutive rows, null before n of them."""
    w = ordered().rowsBetween(1 - n, 0)
    return F.when(F.count(value).over(w) == n, F.sum(value).over(w))


def complete_mean(df: DataFrame, group: Column, out: str, need: int) -> DataFrame:
    """Means of the groups that have `need` values."""
    return df.groupBy("place", group.alias(out)).agg(F.avg("value").alias("value"), F.count("value").alias("_n")).where(F.col("_n") == need).drop("_n")


def asof(left: DataFrame, right: DataFrame, value: str, out: str, most: int | None = None) -> DataFrame:
    """The last right value (place, idx, value) at or before each left key, at most `most` keys old. A union and a window, no range join."""
    right = right.where(F.col(value).isNotNull()).select("place", "idx", F.struct("idx", value).alias("_seen"))
    rows = left.withColumn("_seen", F.lit(None).cast(right.schema["_seen"].dataType)).withColumn("_is", F.lit(1))
    both = rows.unionByName(right.withColumn("_is", F.lit(0)), allowMissingColumns=True)
    w = W.partitionBy("place").orderBy("idx", "_is").rowsBetween(W.unboundedPreceding, 0)
    seen = both.withColumn("_seen", F.last("_seen", True).over(w)).where("_is = 1")
    found = F.col(f"_seen.{value}")
    fresh = found if most is None else F.when(F.col("idx") - F.col("_seen.idx") <= most, found)
    return seen.withColumn(out, fresh).drop("_seen", "_is")


def growth(now: Column, before: Column) -> Column:
    return 100 * (F.try_divide(now, before) - 1)


def expanding_z(value: str = "value", least: int = 8) -> Column:
    """z of each row against the rows up to it, with no look-ahead."""
    w = ordered().rowsBetween(W.unboundedPreceding, 0)
    return F.when(F.count(value).over(w) >= least, F.try_divide(F.col(value) - F.avg(value).over(w), F.stddev_samp(value).over(w)))


def winsorised(df: DataFrame, value: str, group: str, low: float = 0.025, high: float = 0.975, approximate: int | None = None) -> DataFrame:
    """df with the value held to its group's percentiles; nulls stay. approximate: the accuracy of approximate percentiles, for groups whose different values do not fit a task."""
    ends = F.percentile(value, [low, high]) if approximate is None else F.percentile_approx(value, [low, high], approximate)
    bounds = df.groupBy(group).agg(ends.alias("_w"))
    held = F.when(F.col(value).isNotNull(), F.least(F.greatest(F.col(value), F.col("_w")[0]), F.col("_w")[1]))
    return df.join(bounds, df[group].eqNullSafe(bounds[group]), "left").drop(bounds[group]).withColumn(value, held).drop("_w")


def set_changes(before: DataFrame, now: DataFrame) -> DataFrame:
    """The different rows of two tables of equal columns, with `change`: kept (in both), new or gone."""
    told = lambda df, change: df.withColumn("change", F.lit(change))
    return told(before.intersect(now), "kept").unionByName(told(now.subtract(before), "new")).unionByName(told(before.subtract(now), "gone"))


def drawdown_event(value: str = "value", ahead: int = 12, drop: float = -0.10) -> Column:
    """1 if the lowest of the next `ahead` keys is so far below; null unless all are known."""
    w = ordered().rangeBetween(1, ahead)
    return F.when(F.count(value).over(w) == ahead, (F.try_divide(F.min(value).over(w), F.col(value)) - 1 <= drop).cast("int"))


def drawdown(value: str = "value") -> Column:
    return 100 * (F.try_divide(F.col(value), F.max(value).over(ordered().rowsBetween(W.unboundedPreceding, 0))) - 1)


def mid_rank(value: Column, group: Column) -> Column:
    return F.rank().over(W.partitionBy(group).orderBy(value)) + (F.count(F.lit(1)).over(W.partitionBy(group, value)) - 1) / 2


def spearman(df: DataFrame, x: str, y: str, group: str) -> DataFrame:
    """Rank correlation by group, from 5 pairs and 2 distinct values on."""
    df = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    ranked = df.select(group, x, y, mid_rank(F.col(x), F.col(group)).alias("_x"), mid_rank(F.col(y), F.col(group)).alias("_y"))
    out = ranked.groupBy(group).agg(F.corr("_x", "_y").alias("rho"), F.count("*").alias("n"), F.count_distinct(x).alias("_a"), F.count_distinct(y).alias("_b"))
    return out.select(group, F.when((F.col("n") >= 5) & (F.col("_a") >= 2) & (F.col("_b") >= 2), F.col("rho")).alias("rho"), "n")


def auc(df: DataFrame, score: str, event: str, group: str) -> DataFrame:
    """Area under the curve by rank sums; null unless both classes occur."""
    ranked = df.where(F.col(score).isNotNull() & F.col(event).isNotNull()).select(group, event, mid_rank(F.col(score), F.col(group)).alias("_r"))
    p, n = F.sum(F.col(event)).cast("double"), F.sum(1 - F.col(event)).cast("double")
    return ranked.groupBy(group).agg(F.try_divide(F.sum(F.when(F.col(event) == 1, F.col("_r"))) - p * (p + 1) / 2, p * n).alias("auc"))


def episodes(df: DataFrame, event: str) -> DataFrame:
    """Runs of consecutive rows with event 1: place, first and last key, number of rows."""
    one = F.coalesce(F.col(event) == 1, F.lit(False))
    new = (one & ~F.coalesce(F.lag(one).over(ordered()), F.lit(False))).cast("int")
    runs = df.withColumn("_run", F.sum(new).over(ordered().rowsBetween(W.unboundedPreceding, 0))).where(one)
    return runs.groupBy("place", "_run").agg(F.min("idx").alias("first"), F.max("idx").alias("last"), F.count("*").alias("n")).drop("_run")


def splice(main: DataFrame, older: DataFrame) -> DataFrame:
    """main, continued backwards with older scaled at the first common key."""
    both = main.select("place", "idx", F.col("value").alias("m")).join(older.select("place", "idx", F.col("value").alias("o")), ["place", "idx"], "full_outer")
    link = F.min_by(F.try_divide("m", "o"), F.when(F.col("m").isNotNull() & F.col("o").isNotNull(), F.col("idx"))).over(W.partitionBy("place"))
    begin = F.min(F.when(F.col("m").isNotNull(), F.col("idx"))).over(W.partitionBy("place"))
    return both.select("place", "idx", F.coalesce("m", F.when(F.col("idx") < begin, F.col("o") * link)).alias("value")).where("value is not null")


def top_movers(df: DataFrame, value: str, k: int) -> DataFrame:
    """The k largest and k smallest values with their direction; ties by place."""
    up = df.where(F.col(value).isNotNull()).orderBy(F.desc(value), "place").limit(k).withColumn("direction", F.lit("up"))
    down = df.where(F.col(value).isNotNull()).orderBy(value, "place").limit(k).withColumn("direction", F.lit("down"))
    return up.unionByName(down)


def correlation_at_lags(df: DataFrame, lead: DataFrame, lags: list[int]) -> DataFrame:
    """place, lag and the correlation of growth with the leader's growth `lag` keys before."""
    shifted = lead.select(F.col("idx").alias("_idx"), F.col("value").alias("_lead"), F.explode(F.array(*map(F.lit, lags))).alias("lag"))
    rows = df.join(shifted.withColumn("idx", F.col("_idx") + F.col("lag")).drop("_idx"), "idx")
    return rows.groupBy("place", "lag").agg(F.corr("value", "_lead").alias("r"), F.count("*").alias("n"))


def percentile_ranks(df: DataFrame, value: str, out: str, values_a_range: int = 250_000) -> DataFrame:
    """pct_rank() for tables of any size: no task sorts all rows.

    The different values are counted once and dealt to ranges of about `values_a_range`
    values; a value's rank is the count of the ranges below plus its rank inside.  Counts
    and ranges are written, so a lost executor does not deal anew.
    """
    counts = stored(df.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("_v")).agg(F.count("*").alias("_t")))
    ranges = max(1, -(-counts.count() // values_a_range))
    placed = stored(counts.repartitionByRange(ranges, "_v").withColumn("_b", F.spark_partition_id()))
    per = placed.groupBy("_b").agg(F.sum("_t").alias("_n"))
    w = W.orderBy("_b")  # a row a range
    below = per.select("_b", (F.sum("_n").over(w) - F.col("_n")).alias("_below"), F.sum("_n").over(W.partitionBy(F.lit(1))).alias("_all"))
    inside = F.sum("_t").over(W.partitionBy("_b").orderBy("_v")) - F.col("_t")
    ranks = placed.withColumn("_in", inside).join(below, "_b").select("_v", (100 * (F.col("_below") + F.col("_in") + (F.col("_t") + 1) / 2) / F.col("_all")).alias(out))
    return df.join(ranks, F.col(value) == F.col("_v"), "left").drop("_v")
