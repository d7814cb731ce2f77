"""Hierarchies, pivots and indicators of stated columns, and joins by name in any script."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def region_rollup(df: DataFrame, levels: list[str], keys: list[str], value: str, weight: str | None = None) -> DataFrame:
    """keys, levels, depth, n, weight, value: weighted means of a value at every level of a hierarchy (the widest first) and overall (depth 0).

    All levels come from one aggregation over grouping sets, so rows are shuffled once,
    as partial sums.  Levels below a row's depth are null.  Null values and null or
    non-positive weights do not count in the mean; n counts the rows that do.
    """
    w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    rows = df.select(*keys, *levels, F.when(F.col(value).isNotNull() & (w > 0), w).alias("_w"), F.col(value).cast("double").alias("_v"))
    sets = [[F.col(c) for c in [*keys, *levels[:k]]] for k in range(len(levels) + 1)]
    depth = sum((1 - F.grouping(c) for c in levels), F.lit(0))
    out = rows.groupingSets(sets, *keys, *levels).agg(depth.cast("int").alias("depth"), F.count("_w").alias("n"), F.sum("_w").alias("weight"), F.try_divide(F.sum(F.col("_w") * F.col("_v")), F.sum("_w")).alias("value"))
    return out.select(*keys, *levels, "depth", "n", "weight", "value")


def wide(df: DataFrame, key: str, column: str, names: dict, value: str = "value") -> DataFrame:
    """key and a column for each stated value of `column` ({value: name}); null where a key lacks it, the largest of several. No job is run to find the columns."""
    cells = [F.max(F.when(F.col(column) == v, F.col(value))).alias(n) for v, n in names.items()]
    return df.groupBy(key).agg(*cells)


def long(df: DataFrame, key: str, names: dict, column: str = "column", value: str = "value") -> DataFrame:
    """The reverse of wide(): a row for each stated column that is not null."""
    cells = F.array(*[F.struct(F.lit(v).alias(column), F.col(n).alias(value)) for v, n in names.items()])
    return df.select(key, F.inline(cells)).where(F.col(value).isNotNull())


def indicators(df: DataFrame, column: str, values: list, prefix: str, reference=None) -> DataFrame:
    """df with a 0/1 column for each stated value but the reference, named prefix + value; null values have 0 in all."""
    return df.withColumns({f"{prefix}{v}": F.coalesce((F.col(column) == v).cast("double"), F.lit(0.0)) for v in values if v != reference})


def most_frequent(df: DataFrame, column: str) -> Column:
    """The most frequent value of a column (ties: the smallest), as a scalar subquery."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counts.agg(F.min_by(column, F.struct((-F.col("n")).alias("n"), F.col(column)))).scalar()


def by_letters(name: Column) -> Column:
    """A name for comparisons: case, accents and punctuation aside, in any script.

    The comparison is a collation of Spark's, not a list of letters, so joins and
    groups over the result match Łódź with lodz and Ōsaka with osaka.
    """
    words = F.trim(F.regexp_replace(name, r"[^\p{L}\p{M}\p{N}]+", " "))
    return F.collate(words, "UNICODE_CI_AI")


def match_names(rows: DataFrame, name: str, known: DataFrame, known_name: str, code: str) -> DataFrame:
    """rows with the code of the known name that is the same by letters (of several, the smallest code); null where there is none."""
    own = known.where(F.col(known_name).isNotNull()).groupBy(by_letters(F.col(known_name)).alias("_l")).agg(F.min(code).alias(code))
    return rows.join(own, by_letters(F.col(name)) == F.col("_l"), "left").drop("_l")
