"""Tables of parishes: prices, rents, licences, buildings, neighbours. Long frames with place = a parish's code; years or quarters as idx."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .features import change, latest, volatility


def coded(df: DataFrame, code: Column, value: str = "value") -> DataFrame:
    """The rows with a parish code (functions.keys.parish) and a value; of several rows of a code and key the last by `ord`, where there is one."""
    rows = df.withColumn("place", code).where(F.col("place").isNotNull() & F.col(value).isNotNull())
    if "ord" not in df.columns:
        return rows
    return rows.withColumn("_k", F.row_number().over(W.partitionBy("place", "idx").orderBy(F.desc("ord")))).where("_k = 1").drop("_k")


def price_table(sales: DataFrame, towns: DataFrame, town_of: Column, least_steps: int = 6, least: int = 20) -> DataFrame:
    """place, town, price, g1y, rel_town, volatility, volatile of the parishes with a price at the last quarter.

    towns: town, town_price. Volatile are the quarter of parishes that move most,
    where `least` have a volatility.
    """
    rows = latest(sales, {"_b": 4}, "price").where("price is not null").select("place", town_of.alias("town"), "price", change("price", "_b").alias("g1y"))
    rows = rows.join(towns, "town", "left").withColumn("rel_town", change("price", "town_price")).drop("town_price")
    moves = volatility(sales).where(F.col("steps") >= least_steps).drop("steps")
    rows = rows.join(moves, "place", "left")
    limit = rows.agg(F.when(F.count("volatility") >= least, F.percentile("volatility", 0.75)).alias("x")).scalar()
    return rows.withColumn("volatile", F.col("volatility") >= limit)


def rent_table(rent: DataFrame, contracts: DataFrame | None = None) -> DataFrame:
    """place, rent, rent_g1y, rent_g3y and the contracts of their last year."""
    rows = latest(rent, {"_1": 1, "_3": 3}, "rent").where("rent is not null").select("place", "rent", change("rent", "_1").alias("rent_g1y"), change("rent", "_3").alias("rent_g3y"))
    return rows if contracts is None else rows.join(latest(contracts, name="rent_contracts"), "place", "left")


def licences(df: DataFrame, homes: DataFrame | None = None) -> DataFrame:
    """place, lic_new, lic_3y, lic_per_100: homes licensed in the last year and the last three, per hundred homes (place, homes)."""
    last = df.agg(F.max("idx")).scalar()
    rows = df.groupBy("place").agg(F.max(F.when(F.col("idx") == last, F.col("value"))).alias("lic_new"), F.sum(F.when(F.col("idx") > last - 3, F.col("value"))).alias("lic_3y")).where("lic_3y is not null")
    if homes is None:
        return rows.withColumn("lic_per_100", F.lit(None).cast("double"))
    return rows.join(homes, "place", "left").withColumn("lic_per_100", F.when(F.col("homes") > 0, F.col("lic_3y") / F.col("homes") * 100)).drop("homes")


def buildings(counts: DataFrame) -> DataFrame:
    """place, buildings, old_share, repair_share. counts: place, kind (total, pre1919, 1919_1945, 1946_1960, repair_mid, repair_deep), value."""
    of = lambda *kinds: F.coalesce(F.sum(F.when(F.col("kind").isin(*kinds), F.col("value"))), F.lit(0.0))
    rows = counts.groupBy("place").agg(F.max(F.when(F.col("kind") == "total", F.col("value"))).alias("buildings"), of("pre1919", "1919_1945", "1946_1960").alias("_old"), of("repair_mid", "repair_deep").alias("_repair")).where("buildings > 0")
    share = lambda c: F.least(F.greatest(F.col(c) / F.col("buildings"), F.lit(0.0)), F.lit(1.0))
    return rows.select("place", "buildings", share("_old").alias("old_share"), share("_repair").alias("repair_share"))


def census_shares(counts: DataFrame) -> DataFrame:
    """place, homes, secondary_share, vacant_share, vacant_market_share. counts: place, kind (total, secondary, vacant_market, vacant_other), value."""
    of = lambda kind: F.max(F.when(F.col("kind") == kind, F.col("value")))
    rows = counts.groupBy("place").agg(of("total").alias("homes"), of("secondary").alias("_s"), of("vacant_market").alias("_m"), of("vacant_other").alias("_o")).where("homes > 0")
    return rows.select("place", "homes", (F.col("_s") / F.col("homes")).alias("secondary_share"), ((F.col("_m") + F.col("_o")) / F.col("homes")).alias("vacant_share"), (F.col("_m") / F.col("homes")).alias("vacant_market_share"))


def with_neighbours(table: DataFrame, edges: DataFrame, least: int = 2) -> DataFrame:
    """table (place, price) with n_nb and rel_nb: the price against the median of the neighbours that have one. edges: place, neighbour."""
    priced = table.where("price is not null").select(F.col("place").alias("neighbour"), F.col("price").alias("_p"))
    near = edges.join(priced, "neighbour").groupBy("place").agg(F.count("*").alias("n_nb"), F.percentile("_p", 0.5).alias("_m"))
    rows = table.join(near, "place", "left")
    known = F.col("price").isNotNull()
    return rows.withColumns({"n_nb": F.when(known, F.coalesce("n_nb", F.lit(0))).otherwise(0), "rel_nb": F.when(known & (F.col("n_nb") >= least), change("price", "_m"))}).drop("_m")


def parish_table(prices: DataFrame, rents: DataFrame, incomes: DataFrame, census: DataFrame, names: list[DataFrame]) -> DataFrame:
    """One row a parish that any source has; names (place, name) in order of preference; dico: the code's first four digits."""
    out = prices
    for df in (rents, incomes, census):
        out = out.join(df, "place", "full_outer")
    for k, df in enumerate(names):
        out = out.join(df.select("place", F.col("name").alias(f"_n{k}")).dropDuplicates(["place"]), "place", "left")
    found = F.coalesce(*[F.col(f"_n{k}") for k in range(len(names))])
    return out.withColumns({"name": found, "dico": F.left(F.col("place").cast("string"), F.lit(4))}).drop(*[f"_n{k}" for k in range(len(names))])


def top_parishes(table: DataFrame, value: str, k: int = 3, group: str = "town") -> DataFrame:
    """The k best parishes of each group with their rank; ties by place."""
    rank = F.row_number().over(W.partitionBy(group).orderBy(F.col(value).desc_nulls_last(), "place"))
    return table.where(F.col(value).isNotNull()).withColumn("rank", rank).where(F.col("rank") <= k)
