from pyspark.sql import functions as F

from lotmetrics.functions import finance, keys
from lotmetrics.operators import panel as P


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_periods(spark):
    for raw, label, key in (("1.º Trimestre de 2024", "2024Q1", 202401), ("2024Q3", "2024Q3", 202403), ("Março de 2023", "2023-03", 202303), ("2021", "2021", 202100), ("2022-11", "2022", 202200)):
        got = one(spark, keys.period(F.lit(raw)))
        assert (got["label"], got["sort_key"]) == (label, key)
    assert one(spark, keys.period(F.lit("sem data"))) is None


def test_places_and_numbers(spark):
    for code, level in (("PT", "national"), ("9990102", "municipality"), ("999010203", "parish"), ("99Z", "nuts3"), ("9", "nuts1"), ("99", "nuts2"), ("zz-", "other")):
        assert one(spark, keys.level(F.lit(code))) == level
    assert one(spark, keys.municipality(F.lit(" 9z90102"))) == "0102"
    for raw, value in (("1.234,5", 1234.5), ("1,5", 1.5), (" 12 ", 12.0), ("x", None), ("..", None), ("abc", None)):
        assert one(spark, keys.number(F.lit(raw))) == value
    assert one(spark, keys.plain(F.lit("Vila  Nova-de Gaía"))) == "vila nova de gaia"


def test_loans(spark):
    loan, rate, years = F.lit(100_000.0), F.lit(3.6), F.lit(30.0)
    pay = one(spark, finance.instalment(loan, rate, years))
    assert abs(one(spark, finance.capacity(F.lit(pay), rate, years)) - 100_000) < 1e-6
    assert abs(one(spark, finance.balance(loan, rate, years, F.lit(360.0)))) < 1e-6
    assert one(spark, finance.instalment(loan, F.lit(0.0), years)) == 100_000 / 360


def test_percent_rank_of_ties_and_nulls(spark):
    rows = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 2.0), (4, 3.0), (5, None)], "place int, v double")
    got = [r["p"] for r in rows.withColumn("p", P.pct_rank(F.col("v"))).orderBy("place").collect()]
    assert got == [25, 62.5, 62.5, 100, None]


def test_calendar_lag_skips_gaps(spark):
    rows = spark.createDataFrame([(1, 1, 10.0), (1, 2, 11.0), (1, 6, 12.0)], "place int, idx int, value double")
    got = P.lagged(rows, 4, "before").orderBy("idx").collect()
    assert [r["before"] for r in got] == [None, None, 11.0]


def test_expanding_score_has_no_look_ahead(spark):
    rows = spark.range(12).select(F.lit(1).alias("place"), F.col("id").alias("idx"), (F.col("id") * F.col("id")).cast("double").alias("value"))
    cut = [r["z"] for r in rows.where("idx < 10").withColumn("z", P.expanding_z()).orderBy("idx").collect()]
    full = [r["z"] for r in rows.withColumn("z", P.expanding_z()).orderBy("idx").collect()]
    assert full[:10] == cut and full[6] is None and full[7] is not None


def test_bounded_asof(spark):
    left = spark.createDataFrame([(1, 5), (1, 9)], "place int, idx int")
    right = spark.createDataFrame([(1, 4, 1.0), (1, 6, None)], "place int, idx int, v double")
    assert [r["x"] for r in P.asof(left, right, "v", "x", 2).orderBy("idx").collect()] == [1.0, None]


def test_total_return(spark):
    got = one(spark, finance.total_return(F.lit(100.0), F.lit(121.0), F.lit(1.0), F.lit(1.1), F.lit(0.08), 1))
    assert abs(got["price_real"] - 0.1) < 1e-12 and abs(got["inflation"] - 0.1) < 1e-12 and abs(got["total"] - 0.16) < 1e-12
    assert one(spark, finance.total_return(F.lit(0.0), F.lit(1.0), F.lit(1.0), F.lit(1.0), F.lit(0.08)))["total"] is None
