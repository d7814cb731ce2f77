"""The panel's tables and readings: ranking, affordability, guide, map domains. Columns of feature rows (place, name, price and more)."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import finance, keys
from . import calculators as C
from .features import change

#: Fixed value: yearly costs of an owner as a share of the price.
OWN_COST = 0.013


def ranked_table(df: DataFrame, sort: str, ascending: bool = False, search: str = "") -> DataFrame:
    """The rows whose name holds the text, numbered by a column of any type, nulls last; ties by place."""
    if search.strip():
        df = df.where(F.contains(F.lower("name"), F.lower(F.lit(search.strip()))))
    order = F.col(sort).asc_nulls_last() if ascending else F.col(sort).desc_nulls_last()
    return df.withColumn("position", F.row_number().over(W.orderBy(order, "place")))  # a row a place


def band_summary(df: DataFrame) -> DataFrame:
    """One row: places in each band and without one, median prices of red and green ones, their ratio and reading (cheaper, dearer, alike)."""
    of = lambda b: F.count_if(F.coalesce("band", F.lit("none")) == b).alias(b)
    mid = lambda b: F.percentile(F.when(F.col("band") == b, F.col("price")), 0.5)
    rows = df.agg(of("red"), of("amber"), of("green"), of("none"), mid("red").alias("price_red"), mid("green").alias("price_green")).withColumn("ratio", F.try_divide("price_red", "price_green"))
    return rows.withColumn("reading", F.when(F.col("ratio") <= 0.85, "cheaper").when(F.col("ratio") >= 1.15, "dearer").when(F.col("ratio").isNotNull(), "alike"))


def rent_risers(parishes: DataFrame, k: int = 12, least: float = 50, rows: int = 10) -> DataFrame:
    """Parishes whose rent rose most in three years, with enough contracts (or an unknown number); none where fewer than `rows` qualify."""
    held = parishes.where(F.col("rent_g3y").isNotNull() & (F.col("rent_contracts").isNull() | (F.col("rent_contracts") >= least)))
    enough = held.agg(F.count("*").alias("_n")).where(F.col("_n") >= rows).select("_n")
    return held.join(F.broadcast(enough), F.lit(True)).drop("_n").orderBy(F.desc("rent_g3y"), "place").limit(k)


def parish_list(parishes: DataFrame, town: Column) -> DataFrame:
    """A town's parishes, the dearest first, those without a price last and by name."""
    return parishes.where(town).withColumn("position", F.row_number().over(W.orderBy(F.col("price").desc_nulls_last(), "name")))


def domain(value: Column, diverging: bool = False) -> Column:
    """struct<low,high>: the aggregate's 5th and 95th percentile, symmetric where colours diverge."""
    low, high = F.percentile(value, 0.05), F.percentile(value, 0.95)
    reach = F.greatest(F.abs(low), F.abs(high))
    reach = F.when(reach == 0, 1.0).otherwise(reach)
    made = lambda a, b: F.struct(a.alias("low"), b.alias("high"))
    own = made(-reach, reach) if diverging else F.when(low == high, made(low, low + 1)).otherwise(made(low, high))
    return F.when(F.count(value) < 2, made(F.lit(0.0), F.lit(1.0))).otherwise(own)


def stops(of: Column, n: int) -> Column:
    """n values from a domain's low to its high, evenly."""
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: of["low"] + (of["high"] - of["low"]) * i / (n - 1))


def affordability(df: DataFrame, rate: float, area: float = 90, down: float = 10, years: int = 30, earners: int = 1, shock: float = 2, monthly: str = "income", salaries: int = 14, use: str = "own", young: bool = False) -> DataFrame:
    """df (price, rent, income, place code `code`) with column aff: buying and renting the reference home against incomes."""
    p, r, y = F.col("price") * area, F.lit(float(rate)), F.lit(float(years))
    loan, income = p * (1 - down / 100), F.when(F.col(monthly) > 0, F.col(monthly) * earners)
    rows = df.withColumns({"_home": p, "_loan": loan, "_inc": income, "_rent": F.col("rent") * area})
    pay = lambda extra: finance.instalment(F.col("_loan"), r + extra, y)
    taxes = finance.purchase_taxes(F.col("_home"), F.col("_loan"), use, young, keys.islands(F.col("code")))
    rows = rows.withColumns({"_pay": pay(0.0), "_tax": taxes["total"]})
    rent = F.when(F.col("_rent") > 0, F.col("_rent"))
    made = F.struct(
        F.col("_home").alias("home"), (F.col("_home") - F.col("_loan")).alias("down"), F.col("_pay").alias("pay"), (F.col("_pay") / F.col("_inc")).alias("effort"), (pay(float(shock)) / F.col("_inc")).alias("effort_stressed"), (pay(C.SHOCK) / F.col("_inc")).alias("effort_rule"),
        F.col("_tax").alias("tax"), (F.col("_home") - F.col("_loan") + F.col("_tax")).alias("cash"), (F.col("_home") / (F.col("_inc") * salaries)).alias("years_of_income"), rent.alias("rent_home"), (F.col("_pay") / rent - 1).alias("pay_vs_rent"), (rent / F.col("_inc")).alias("rent_effort"),
        (rate / 100 + OWN_COST - rent * 12 / F.col("_home")).alias("breakeven"),
    )
    return rows.withColumn("aff", F.when(F.col("price").isNotNull(), made)).select(*df.columns, "aff")


def parish_effort(parishes: DataFrame, rate: float, area: float = 90, down: float = 10, years: int = 30, earners: int = 1) -> DataFrame:
    """parishes (price, irs_median) with irs_month and effort."""
    pay = finance.instalment(F.col("price") * area * (1 - down / 100), F.lit(float(rate)), F.lit(float(years)))
    month = F.col("irs_median") / 12
    return parishes.withColumns({"irs_month": month, "effort": pay / F.when(month > 0, month * earners)})


def against_breakeven(mid: Column, low: Column, high: Column, breakeven: Column) -> Column:
    """above, below or undecided: where a forecast's bounds lie against the breakeven growth."""
    return F.when(mid.isNull() | breakeven.isNull(), None).when(low > breakeven, "above").when(high < breakeven, "below").otherwise("undecided")


def safety_margins(df: DataFrame, paid: Column, references: list[str]) -> DataFrame:
    """place, reference, value, difference: what is paid against each known reference price."""
    rows = df.select("place", paid.alias("_paid"), F.explode(F.array(*[F.struct(F.lit(c).alias("reference"), F.col(c).cast("double").alias("value")) for c in references])).alias("x")).where("x.value is not null")
    return rows.select("place", "x.reference", "x.value", change("_paid", "x.value").alias("difference"))


def crisis_scenario(prices: Column, real: Column, rates: DataFrame) -> tuple[Column, DataFrame]:
    """The deepest fall of prices from 2007 to 2014 (and of real ones) and the steepest yearly rise of rates."""
    fall = lambda s: C.deepest_fall(s, F.lit("2007"), F.lit("2014"))
    return F.struct((-fall(prices)["drop"]).alias("drop"), (-fall(real)["drop"]).alias("drop_real")), C.steepest_rise(rates)


# the guide


def parish_totals(parishes: DataFrame, town: str = "town") -> DataFrame:
    """town, services (schools and health a thousand homes), flooded and repair shares weighed by homes and buildings."""
    c = F.col
    n = F.coalesce("homes", F.lit(0.0))
    counted = c("n_school").isNotNull() & (n > 0)
    repair = c("repair_share").isNotNull() & (c("buildings") > 0)
    sums = parishes.groupBy(town).agg(
        F.sum(F.when(counted, c("n_school") + F.coalesce("n_health", F.lit(0.0)))).alias("sv"), F.sum(F.when(counted, n)).alias("svn"), F.sum(F.when(n > 0, F.coalesce("flooded", F.lit(0.0)) * n)).alias("fl"), F.sum(F.when(n > 0, n)).alias("fln"),
        F.sum(F.when(repair, c("repair_share") * c("buildings"))).alias("rp"), F.sum(F.when(repair, c("buildings"))).alias("rpn"),
    )
    return sums.select(town, (F.try_divide("sv", "svn") * 1000).alias("services"), F.try_divide("fl", "fln").alias("flood"), F.try_divide("rp", "rpn").alias("repair"))


def small_rental_market(contracts: Column, least: float = 100) -> Column:
    return F.coalesce(contracts < least, F.lit(True))


def in_zone(df: DataFrame, districts: list[str] | None = None, coast: bool | None = None, near: tuple[float, float] | None = None, km: float = 30) -> DataFrame:
    """The places in the districts (two digits of the code), on or off the coast, within so many kilometres of a point."""
    if districts:
        df = df.where(F.left("code", F.lit(2)).isin(*districts))
    if coast is not None:
        df = df.where(F.coalesce("coastal", F.lit(False)) == coast)
    if near is not None:
        d = finance.haversine(F.lit(near[0]), F.lit(near[1]), F.col("lat"), F.col("lon"))
        df = df.where(F.coalesce(d <= km, F.lit(True)))
    return df


def centroids(polygons: DataFrame, key: str = "place") -> DataFrame:
    """key, x, y: the mean corner of the ring with the most corners."""
    biggest = F.aggregate("rings", F.array().cast("array<array<double>>"), lambda a, r: F.when(F.size(r) > F.size(a), r).otherwise(a))
    mean = lambda k: F.aggregate(biggest, F.lit(0.0), lambda a, p: a + p[k]) / F.size(biggest)
    return polygons.where(F.size("rings") > 0).select(key, mean(0).alias("x"), mean(1).alias("y"))


def guide(candidates: DataFrame, criteria: DataFrame, budget: Column, cost: Column, keys_: list[str], least_fit: float = -0.05) -> DataFrame:
    """place, cost, fit, score, missing, position: candidates that the budget fits (to 5 %), by weighted percentiles.

    candidates: place and the criteria's columns; `fit` itself may be a criterion.
    """
    rows = candidates.withColumn("_cost", cost).where(F.col("_cost").isNotNull()).withColumn("fit", F.try_divide(budget, F.col("_cost")) - 1).where(F.col("fit") >= least_fit)
    values = rows.select(F.col("place").alias("id"), F.explode(F.array(*[F.struct(F.lit(k).alias("key"), F.col(k).cast("double").alias("value")) for k in keys_])).alias("x")).select("id", "x.*")
    ranked = C.rank_by(values, criteria).select(F.col("id").alias("place"), "score", "missing")
    out = rows.select("place", F.col("_cost").alias("cost"), "fit").join(ranked, "place")
    return out.withColumn("position", F.row_number().over(W.orderBy(F.desc("score"), "place")))


# tenants and rents

#: The shares of an income up to which a rent is carried easily, and at all; shares of households from which a rent is viable, or tight.
EASY, MOST, MANY, SOME = 0.35, 0.50, 0.30, 0.15
#: How far from a reference a value still agrees with it, and how far it is well off.
AGREES, WELL = 0.10, 0.25


def burden(share: Column) -> Column:
    """easy, heavy or too heavy: a rent as a share of an income."""
    return F.when(share <= EASY, "easy").when(share <= MOST, "heavy").when(share.isNotNull(), "too heavy")


def tenant_profiles(rows: DataFrame, key: str = "place") -> DataFrame:
    """key, profile, income (a month), share, burden: who carries a rent.

    rows: key, rent (a month), parish_irs and irs_median (yearly incomes of one person in
    the parish and the municipality), wage (a month); a profile without an income is
    left out.
    """
    month = {"one, parish": F.col("parish_irs") / 12, "one, municipality": F.col("irs_median") / 12, "two, municipality": 2 * F.col("irs_median") / 12, "one wage": F.col("wage"), "two wages": 2 * F.col("wage")}
    each = rows.select(key, "rent", F.inline(F.array(*[F.struct(F.lit(k).alias("profile"), v.cast("double").alias("income")) for k, v in month.items()]))).where("income > 0 and rent is not null")
    share = F.col("rent") / F.col("income")
    return each.select(key, "profile", "income", share.alias("share"), burden(share).alias("burden"))


def tenant_verdict(rows: DataFrame, households: DataFrame, key: str = "place") -> DataFrame:
    """key, easy (number of profiles), above (share of the households that earn enough), verdict: viable, tight or hard.

    households: key, above, null where brackets are not known. Many households or none
    known and a profile that carries the rent make it viable; a profile or some
    households make it tight.
    """
    easy = tenant_profiles(rows, key).groupBy(key).agg(F.count_if(F.col("burden") == "easy").alias("easy"))
    out = rows.select(key).join(easy, key, "left").join(households.select(key, "above"), key, "left").withColumn("easy", F.coalesce("easy", F.lit(0).cast("long")))
    many = F.col("above").isNull() | (F.col("above") >= MANY)
    some = (F.col("easy") > 0) | F.coalesce(F.col("above") >= SOME, F.lit(False))
    return out.withColumn("verdict", F.when((F.col("easy") > 0) & many, "viable").when(some, "tight").otherwise("hard"))


def against(value: Column, reference: Column) -> Column:
    """struct<difference, reading> of a value against a reference: aligned, above, below, well above or well below."""
    d = F.try_divide(value, reference) - 1
    side = F.when(d > 0, "above").otherwise("below")
    return F.when(d.isNotNull(), F.struct(d.alias("difference"), F.when(F.abs(d) <= AGREES, "aligned").when(F.abs(d) <= WELL, side).otherwise(F.concat(F.lit("well "), side)).alias("reading")))


def rent_fit(rows: DataFrame, income: Column, area: Column, limit: Column) -> DataFrame:
    """place, rent_user, fit: the rent of a home of an area as a share of an income (both positive): fits (up to the limit), cheap part (only
    the cheapest quarter does), tight (up to half) or over. rows: place, rent and rent_q1 a square metre."""
    share = F.when(income > 0, F.col("rent") * area / income)
    low = F.when(income > 0, F.col("rent_q1") * area / income)
    fit = F.when(share <= limit, "fits").when(low <= limit, "cheap part").when(share <= MOST, "tight").when(share.isNotNull(), "over")
    return rows.select("place", share.alias("rent_user"), fit.alias("fit"))


def rent_update(rent: Column, coefficient: Column) -> Column:
    """struct<most, more> of a rent that may rise by a legal coefficient."""
    return F.struct((rent * coefficient).alias("most"), (rent * (coefficient - 1)).alias("more"))


#: What a calculation of letting assumes where nothing is said: square metres, parts in percent, years, months and money.
ASSUMED = {"area": 90.0, "down": 20.0, "years": 30.0, "hold": 10.0, "price_growth": 0.0, "vacancy": 1.0, "condo": 30.0, "ins": 150.0, "maint": 5.0, "contract_years": 1.0, "closing": 1000.0, "sell_cost": 5.0, "marginal": 35.0, "imi_rate": 0.3}
PERCENT = ("down", "price_growth", "maint", "sell_cost", "marginal")


def letting_parameters(rows: DataFrame, rate: Column, rent_growth: Column, start_year: int, said: dict[str, Column] | None = None) -> DataFrame:
    """rows (place, price and rent a square metre, imi_rate as a fraction or null) as what calculators.invest needs.

    rate: of the loan, in percent; rent_growth: a fraction; said: columns that count
    instead of the assumed values (and of price and rent, then of the whole home) where
    they are not null. Places without a price or rent are left out.
    """
    told = lambda k: [said[k].cast("double")] if said and k in said else []
    of = lambda k: F.coalesce(*told(k), F.lit(ASSUMED[k]))
    area = F.when(of("area") > 0, of("area")).otherwise(ASSUMED["area"])
    home = {k: F.coalesce(*[F.when(c > 0, c) for c in told(k)], F.col(k) * area) for k in ("price", "rent")}
    parts = {k: of(k) / 100 if k in PERCENT else of(k) for k in ASSUMED if k not in ("area", "imi_rate")}
    more = {"rate": rate, "rent_growth": rent_growth, "imi_rate": F.coalesce("imi_rate", F.lit(ASSUMED["imi_rate"] / 100)), "vpt": F.coalesce(*told("vpt"), F.lit(None).cast("double")), "island": keys.islands(F.col("place").cast("string")), "start_year": F.lit(start_year)}
    out = rows.select("place", *[v.alias(k) for k, v in (home | parts | more).items()])
    return out.where("price > 0 and rent > 0")


def net_yields(rows: DataFrame, rate: Column, rent_growth: Column, start_year: int) -> DataFrame:
    """place, net_yield: of a home bought without a loan and let, in the first year."""
    held = letting_parameters(rows, rate, rent_growth, start_year, {"down": F.lit(100.0)})
    return C.invest(held).select("place", F.col("invest.net_yield").alias("net_yield"))


# readings


def place_readings(features: DataFrame, metrics: list[str], times: float = 2.0) -> DataFrame:
    """place, metric, value, median, difference, reading: each metric against the median place: above, below, level or, from `times` the median on, a multiple.

    A place that lacks a metric has no row for it; a metric without a positive median
    has no multiples.  The medians come from one aggregation.
    """
    middle = features.agg(*[F.percentile(m, 0.5).alias(f"_{m}") for m in metrics])
    each = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"), F.col(f"_{m}").alias("median")) for m in metrics])
    rows = features.join(middle, F.lit(True)).select("place", F.inline(each)).where("value is not null and median is not null")
    d = F.when(F.col("median") > 0, F.col("value") / F.col("median") - 1)
    told = F.when(d >= times - 1, "multiple").when(F.col("value") > F.col("median"), "above").when(F.col("value") < F.col("median"), "below").otherwise("level")
    return rows.select("place", "metric", "value", "median", d.alias("difference"), told.alias("reading"))


def strongest(components: DataFrame) -> DataFrame:
    """place, overall, known, component, score: the mean score, how many components have one and the highest (ties: the first by name), which
    is told only where there are two or more. components: place, component, value, score."""
    held = components.where("value is not null and score is not null")
    best = F.min(F.struct((-F.col("score")).alias("s"), F.col("component").alias("c")))
    rows = held.groupBy("place").agg(F.avg("score").alias("overall"), F.count("*").alias("known"), best.alias("_b"))
    several = F.col("known") > 1
    return rows.select("place", "overall", "known", F.when(several, F.col("_b.c")).alias("component"), F.when(several, -F.col("_b.s")).alias("score"))
