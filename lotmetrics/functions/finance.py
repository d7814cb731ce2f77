"""Housing-finance calculators as column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def instalment(loan: Column, annual_rate: Column, years: Column) -> Column:
    """Monthly payment of an annuity loan; the rate is in percent."""
    r, n = annual_rate / 1200, years * 12
    return F.when(r == 0, F.try_divide(loan, n)).otherwise(loan * r / (1 - F.pow(1 + r, -n)))


def capacity(payment: Column, annual_rate: Column, years: Column) -> Column:
    """The loan that a monthly payment carries."""
    r, n = annual_rate / 1200, years * 12
    return F.when(r == 0, payment * n).otherwise(payment * (1 - F.pow(1 + r, -n)) / r)


def balance(loan: Column, annual_rate: Column, years: Column, months: Column) -> Column:
    """What is owed after so many months."""
    r, n = annual_rate / 1200, years * 12
    return F.when(r == 0, loan * (1 - months / n)).otherwise(loan * (F.pow(1 + r, n) - F.pow(1 + r, months)) / (F.pow(1 + r, n) - 1))


def bracket_tax(value: Column, brackets: list[tuple[float, float]]) -> Column:
    """Progressive tax: (lower limit, rate) in ascending order."""
    tax = F.lit(0.0)
    for k, (low, rate) in enumerate(brackets):
        high = brackets[k + 1][0] if k + 1 < len(brackets) else None
        part = F.greatest((value if high is None else F.least(value, F.lit(high))) - F.lit(low), F.lit(0.0))
        tax = tax + part * F.lit(rate)
    return F.when(value.isNotNull(), tax)


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Kilometres between two points in degrees."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * 6371.0 * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


#: Transfer tax of 2026 on homes (own, second): limit, rate, amount to deduct (none: the rate holds for the whole price).
TRANSFER_TAX = {
    "own": [(106346, 0, 0), (145470, 0.02, 2126.92), (198347, 0.05, 6491.02), (330539, 0.07, 10457.96), (660982, 0.08, 13763.35), (1150853, 0.06, None), (None, 0.075, None)],
    "second": [(106346, 0.01, 0), (145470, 0.02, 1063.46), (198347, 0.05, 5427.56), (330539, 0.07, 9394.50), (633931, 0.08, 12699.89), (1150853, 0.06, None), (None, 0.075, None)],
}
#: Fixed value: the year of the tax tables.
TAX_YEAR = 2026


def tax_tables_stale(today: Column) -> Column:
    """Whether a later year has begun than the one that the tax tables are of."""
    return F.year(today) > TAX_YEAR


#: Limits of the relief for the young, stamp duty on purchase and loan.
YOUNG_LIMITS, STAMP_PURCHASE, STAMP_LOAN = (330539, 660982), 0.008, 0.006


#: On the islands limits are a quarter higher.
ISLANDS = 1.25
#: Fixed value: the year of the tables above.
TAX_YEAR = 2026


def island_brackets(table: list[tuple]) -> list[tuple]:
    """The table with the islands' limits; amounts to deduct follow from a tax without jumps."""
    rounded = lambda x, n=0: float(int(x * 10**n + 0.5)) / 10**n
    out: list[tuple] = []
    for limit, rate, off in table:
        if off is not None:
            off = rounded(out[-1][2] + (rate - out[-1][1]) * out[-1][0], 2) if out else 0
        out.append((None if limit is None else int(rounded(limit * ISLANDS)), rate, off))
    return out


def young_limits(island: bool) -> tuple[int, int]:
    """Up to the first limit the young pay nothing, up to the second one only for what exceeds the first."""
    return tuple(int(x * ISLANDS + 0.5) for x in YOUNG_LIMITS) if island else YOUNG_LIMITS


def tables_stale(today: Column) -> Column:
    return F.year(today) > TAX_YEAR


def by_region(island, make):
    """make(False) on the mainland, make(True) on the islands; island is a bool or a column."""
    return make(island) if isinstance(island, bool) else F.when(island, make(True)).otherwise(make(False))


def transfer_tax(price: Column, use: str = "own", young: bool = False, island=False) -> Column:
    """The bracket of the price; the young pay 8 % beyond the first limit up to the second one on an own home."""
    def make(away: bool) -> Column:
        table = island_brackets(TRANSFER_TAX[use]) if away else TRANSFER_TAX[use]
        tax = None
        for limit, rate, off in reversed(table):
            part = price * rate if off is None else F.greatest(price * rate - F.lit(float(off)), F.lit(0.0))
            tax = part if tax is None else F.when(price <= limit, part).otherwise(tax)
        if young and use == "own":
            free, partly = young_limits(away)
            tax = F.when(price <= partly, 0.08 * F.greatest(price - free, F.lit(0.0))).otherwise(tax)
        return F.when(price.isNotNull(), tax.cast("double"))

    return by_region(island, make)


def purchase_stamp(price: Column, use: str = "own", young: bool = False, island=False) -> Column:
    def make(away: bool) -> Column:
        if not (young and use == "own"):
            return STAMP_PURCHASE * price
        free, partly = young_limits(away)
        return F.when(price <= partly, STAMP_PURCHASE * F.greatest(price - free, F.lit(0.0))).otherwise(STAMP_PURCHASE * price)

    return by_region(island, make)


def purchase_taxes(price: Column, loan: Column, use: str = "own", young: bool = False, island=False) -> Column:
    """struct<transfer, stamp, loan_stamp, total>."""
    transfer, stamp, of_loan = transfer_tax(price, use, young, island), purchase_stamp(price, use, young, island), STAMP_LOAN * F.greatest(loan, F.lit(0.0))
    return F.struct(transfer.alias("transfer"), stamp.alias("stamp"), of_loan.alias("loan_stamp"), (transfer + stamp + of_loan).alias("total"))


def total_return(first: Column, last: Column, deflator_first: Column, deflator_last: Column, gross_yield: Column, years: int = 5, costs: float = 0.25) -> Column:
    """struct<price_real, inflation, yield_net, total>: real price growth a year plus the yield after costs."""
    rise = F.try_divide(deflator_last, deflator_first)
    real = F.pow(F.try_divide(F.try_divide(last, first), rise), F.lit(1 / years)) - 1
    net = gross_yield * (1 - costs)
    return F.struct(real.alias("price_real"), (F.pow(rise, F.lit(1 / years)) - 1).alias("inflation"), net.alias("yield_net"), (real + net).alias("total"))
