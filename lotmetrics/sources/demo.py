"""A synthetic panel without network: squares as places, series by rule."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def places(spark: SparkSession, columns: int = 8, rows: int = 6, parts: int = 1) -> DataFrame:
    """place, name, rings: squares of 0.5 by 0.4 degrees, or `parts` * `parts` parishes in each."""
    n = columns * rows
    cells = spark.range(n * parts * parts).select((F.col("id") % n).alias("t"), F.floor(F.col("id") / n).cast("int").alias("k"))
    w, h = 0.5 / parts, 0.4 / parts
    x, y = -9.5 + (F.col("t") % columns) * 0.5 + (F.col("k") % parts) * w, 37.0 + F.floor(F.col("t") / columns) * 0.4 + F.floor(F.col("k") / parts) * h
    corner = lambda a, b: F.array((x + a * w), (y + b * h))
    code = F.lpad((F.col("t") + 101).cast("string"), 4, "0")
    place = code if parts == 1 else F.concat(code, F.lpad((F.col("k") + 1).cast("string"), 2, "0"))
    return cells.select(place.alias("place"), F.concat(F.lit("Place "), place).alias("name"), F.array(F.array(corner(0, 0), corner(1, 0), corner(1, 1), corner(0, 1))).alias("rings"))


def series(spark: SparkSession, first: int, last: int, n: int = 48, level: float = 1000.0, per_year: int = 4) -> DataFrame:
    """place, idx, value: growth by place, a cycle and noise from the key's hash, the same at every call."""
    grid = spark.range(n).select(F.lpad((F.col("id") + 101).cast("string"), 4, "0").alias("place"), (0.02 + 0.08 * (F.col("id") % 7) / 7).alias("g"), (F.col("id") % 11).alias("k"), F.explode(F.sequence(F.lit(first).cast("bigint"), F.lit(last).cast("bigint"))).alias("idx"))
    years = (F.col("idx") - first) / per_year
    noise = (F.pmod(F.xxhash64("place", "idx"), F.lit(1000)) / 1000 - 0.5) * 0.02
    return grid.select("place", "idx", (level * (1 + F.col("k") / 11) * F.exp(F.col("g") * years + 0.05 * F.sin(years) + noise)).alias("value"))


def boom_and_bust(spark: SparkSession, countries: list[str], quarters: int = 104, first: int = 1999 * 4) -> DataFrame:
    """place, idx, value: every second country rises fast for six years and falls for five; the others rise steadily."""
    listed = spark.createDataFrame([(c, k % 2 == 0) for k, c in enumerate(countries)], "place string, boom boolean")
    grid = listed.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(quarters - 1))))
    up, down = F.least(F.greatest(F.col("i") - 32, F.lit(0)), F.lit(24)), F.least(F.greatest(F.col("i") - 56, F.lit(0)), F.lit(20))
    steady = F.col("i") - F.when(F.col("boom"), up + down).otherwise(0)
    path = 0.006 * steady + F.when(F.col("boom"), 0.028 * up - 0.022 * down).otherwise(0.0)
    return grid.select("place", (F.col("i") + first).cast("bigint").alias("idx"), (90 * F.exp(path)).alias("value"))


def market_rate(spark: SparkSession, quarters: int = 104, first: int = 1999 * 12) -> DataFrame:
    """idx (month), value: a rate that rises from 1 to 4, falls to 0.5 and rises to 3.5 in thirds, with noise from the key's hash."""
    n = quarters * 3
    third = n // 3
    i = F.col("id")
    line = lambda a, b, begin, size: a + (b - a) * (i - begin) / max(size - 1, 1)
    shape = F.when(i < third, line(1.0, 4.0, 0, third)).when(i < 2 * third, line(4.0, 0.5, third, third)).otherwise(line(0.5, 3.5, 2 * third, n - 2 * third))
    noise = (F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000 - 0.5) * 0.2
    return spark.range(n).select((i + first).alias("idx"), (shape + noise).alias("value"))


def tax_rates(places_: DataFrame, year: int = 2025) -> DataFrame:
    """dico, name, year, rate, by_parish, ded_1 to ded_3: property taxes between 0.3 % and 0.45 % by the place's code."""
    code = F.col("place").cast("int")
    return places_.select(F.col("place").alias("dico"), "name", F.lit(year).alias("year"), (0.003 + 0.0005 * (code % 4)).alias("rate"), (code % 5 == 0).alias("by_parish"), F.lit(30.0).alias("ded_1"), F.lit(70.0).alias("ded_2"), F.lit(140.0).alias("ded_3"))
