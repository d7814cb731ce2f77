"""The registry of queries: each with the SQL that states its result."""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return register


def r(c, n: int = 6) -> Column:
    return F.round(c, n)


def rounded(df, digits: int = 6, **also: int):
    """Doubles rounded, for results that are compared to the digit."""
    return df.select(*[F.round(c, also.get(c, digits)).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])
