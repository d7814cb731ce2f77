"""Panels built from the driver's tables: the stand-ins for territorial series."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import month_index, quarter_index
from ..operators.storage import stored  # noqa: F401


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def territory_orders(spark, sf_dir: str) -> DataFrame:
    """Orders with their nation: the customers' side is small and broadcast by Spark where its size allows."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice", "o_orderdate")
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").cast("long").alias("place"))
    return orders.join(customers, "o_custkey")


def quarters(spark, sf_dir: str) -> DataFrame:
    rows = territory_orders(spark, sf_dir)
    return rows.groupBy("place", quarter_index(F.year("o_orderdate"), F.quarter("o_orderdate")).alias("idx")).agg(F.avg("o_totalprice").alias("value"), F.count("*").alias("n"))


def months(spark, sf_dir: str) -> DataFrame:
    rows = territory_orders(spark, sf_dir)
    return rows.groupBy("place", month_index(F.year("o_orderdate"), F.month("o_orderdate")).alias("idx")).agg(F.avg("o_totalprice").alias("value"), F.count("*").alias("n"))


def deflator(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_extendedprice", "l_quantity", "l_shipdate")
    return rows.groupBy(quarter_index(F.year("l_shipdate"), F.quarter("l_shipdate")).alias("idx")).agg(F.avg(F.try_divide("l_extendedprice", "l_quantity")).alias("value"))


def years(spark, sf_dir: str) -> DataFrame:
    """place, idx (year), value, n and urgent: yearly means and counts."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").cast("long").alias("place"))
    rows = orders.join(customers, "o_custkey").groupBy("place", F.year("o_orderdate").cast("bigint").alias("idx"))
    return rows.agg(F.avg("o_totalprice").alias("value"), F.count("*").cast("double").alias("n"), F.count_if(F.col("o_orderpriority") == "1-URGENT").cast("double").alias("urgent"))


def column(df: DataFrame, value, *also: str) -> DataFrame:
    """The frame with another value."""
    return df.select("place", "idx", (F.col(value) if isinstance(value, str) else value).cast("double").alias("value"), *also)


Q = "q as (select c_nationkey::bigint place, (year(o_orderdate) * 4 + quarter(o_orderdate) - 1)::bigint idx, avg(o_totalprice) as value, count(*) n from orders join customer on c_custkey = o_custkey group by 1, 2)"
M = "m as (select c_nationkey::bigint place, (year(o_orderdate) * 12 + month(o_orderdate) - 1)::bigint idx, avg(o_totalprice) as value, count(*) n from orders join customer on c_custkey = o_custkey group by 1, 2)"
D = "d as (select (year(l_shipdate) * 4 + quarter(l_shipdate) - 1)::bigint idx, avg(l_extendedprice / nullif(l_quantity, 0)) as value from lineitem group by 1)"
Y = "y as (select c_nationkey::bigint place, year(o_orderdate)::bigint idx, avg(o_totalprice) as value, count(*)::double n, (count(*) filter (o_orderpriority = '1-URGENT'))::double urgent from orders join customer on c_custkey = o_custkey group by 1, 2)"
