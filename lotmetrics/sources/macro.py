"""Landed price levels of several countries: bases on end, yearly rates after their end, quarters."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import indices as I

#: Countries that the bank's files name otherwise.
OTHER_CODES = {"EL": "GR"}


def bank_code(country: Column) -> Column:
    """The code under which the bank's files have a country."""
    return F.coalesce(F.create_map(*[F.lit(x) for pair in OTHER_CODES.items() for x in pair])[country], country)


def answered(reads: dict[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
    """What each base's reader gives, in order, the ones that fail or have no rows left out; an error if none is left."""
    found, errors = {}, []
    for name, read in reads.items():
        try:
            df = read()
            if df.isEmpty():
                raise ValueError("no rows")
            found[name] = df
        except Exception as e:
            errors.append(f"{name}: {str(e)[:120]}")
    if not found:
        raise RuntimeError(f"no base answered: {'; '.join(errors)}")
    return found


def quarterly_panel(bases: list[DataFrame], rates: DataFrame | None = None) -> DataFrame:
    """place, idx (quarter), value: monthly indices (place, idx, value) of several bases, the first one as it is and the others scaled to it,
    carried on by yearly rates in percent (place, idx, value), as means of the quarters that are whole.

    All places go through each step together: the bases are linked by every place's own common months.
    """
    held = [b.where("value is not null").select("place", "idx", "value") for b in bases]
    monthly = held[0] if len(held) == 1 else I.chained(*held)
    if rates is not None:
        monthly = I.extended_by_rates(monthly, rates.select("place", "idx", "value"))
    return I.monthly_to_quarterly(monthly, 3)
