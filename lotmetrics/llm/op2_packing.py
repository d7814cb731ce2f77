"""Packing by optimal length buckets.

The global histogram of lengths, exact whatever their number, goes to the driver;
dynamic programming picks the bucket boundaries with the least padding; inside
each bucket, rows are numbered and cut into batches of at most `budget` padded
tokens.

Length is the number of words; null and empty texts have length 0 and share the
first bucket.  A row longer than the budget is a batch of its own.  Ties are
ordered by id, then by the text's hash; equal rows are interchangeable.  An
empty table gives no rows.  Words of very long texts are all counted; other columns
are not read, whatever their names.
"""

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, materialize, table


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cheapest(best: np.ndarray, ends: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each j from 1 on the least best[i] + ends[j] * (rows of i+1..j) over i < j, and the smallest such i.

    That i never falls as j grows, so the middle j of a range halves the choice of
    the others; all ranges of a level are worked out at once.
    """
    n = len(ends)
    cost, cut = np.full(n, np.inf), np.full(n, -1)
    low, high, first, last = (np.array([x]) for x in (1, n - 1, 0, n - 2))
    while len(low):
        mid = (low + high) // 2
        sizes = np.minimum(last, mid - 1) - first + 1
        begin = np.cumsum(sizes) - sizes
        i = np.arange(sizes.sum()) - np.repeat(begin - first, sizes)
        j = np.repeat(mid, sizes)
        all_i = best[i] + ends[j] * (total[j + 1] - total[i + 1])
        least = np.minimum.reduceat(all_i, begin)
        at = np.minimum.reduceat(np.where(all_i == np.repeat(least, sizes), i, n), begin)
        cost[mid], cut[mid] = least, at
        left, right = low < mid, mid < high
        low, high, first, last = (np.concatenate(x) for x in ((low[left], mid[right] + 1), (mid[left] - 1, high[right]), (first[left], at[right]), (at[left], last[right])))
    return cost, cut


def boundaries(lengths: list[int], counts: list[int], buckets: int) -> list[int]:
    """The bucket ends with the least padding: sum of count * (end of the row's bucket).

    lengths: ascending largest lengths of the cells.  Best[j] over the last end:
    the cost of a bucket over cells i+1..j is lengths[j] * (count of those cells).
    Ties go to the smaller end.
    """
    if not lengths:
        return []
    ends, total = np.array(lengths, dtype=np.float64), np.concatenate([[0], np.cumsum(np.array(counts, dtype=np.float64))])
    n, best, back = len(ends), ends * total[1:], []
    for _ in range(min(buckets, n) - 1):
        cost, cut = cheapest(best, ends, total)
        better = cost < best
        best = np.where(better, cost, best)
        back.append(np.where(better, cut, -1))
    out, j = [], n - 1
    for cut in [*reversed(back), None]:
        if cut is not None and cut[j] < 0:
            continue
        out.append(int(ends[j]))
        if cut is None:
            break
        j = int(cut[j])
    return out[::-1]


def pack(docs: DataFrame, buckets: int = 16, budget: int = 8192, rows_a_shard: int = 20_000, length: Column | None = None) -> DataFrame:
    """doc_id, n_tokens, bucket, bucket_len, batch (in the bucket), slot (in the batch), padding.

    Rows of a bucket are numbered in shards of a bounded size whose offsets come
    from the shards' counts, so that no task holds a whole bucket.
    """
    rows = docs.select("doc_id", (word_count(F.col("text")) if length is None else length).alias("n_tokens"), F.xxhash64("text").alias("_h"))
    rows = materialize(rows, "lengths")
    per = materialize(rows.groupBy("n_tokens").agg(F.count("*").alias("n")), "histogram")
    # d different lengths need d * d / 2 words at least: a few million rows at 100 TB of text
    hist = per.orderBy("n_tokens").collect()
    ends = boundaries([r["n_tokens"] for r in hist], [r["n"] for r in hist], buckets) or [0]
    shards = max(1, math.ceil(sum(r["n"] for r in hist) / rows_a_shard))
    bucket = F.lit(0)
    end = F.lit(ends[0])
    for k, low in enumerate(ends[:-1]):
        bucket = F.when(F.col("n_tokens") > low, F.lit(k + 1)).otherwise(bucket)
        end = F.when(F.col("n_tokens") > low, F.lit(ends[k + 1])).otherwise(end)
    rows = rows.withColumns({"bucket": bucket, "bucket_len": end.cast("long"), "shard": F.pmod(F.xxhash64("doc_id", "_h"), F.lit(shards)).cast("int")})
    counts = rows.groupBy("bucket", "shard").agg(F.count("*").alias("n"))
    before = counts.select("bucket", "shard", (F.sum("n").over(W.partitionBy("bucket").orderBy("shard")) - F.col("n")).alias("before"))
    at = F.row_number().over(W.partitionBy("bucket", "shard").orderBy("doc_id", "n_tokens", "_h")) - 1
    ranked = rows.withColumn("at", at).join(before, ["bucket", "shard"])
    rank, fit = F.col("before") + F.col("at"), F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest(F.lit(1), F.col("bucket_len"))))
    return ranked.select(
        "doc_id", "n_tokens", "bucket", "bucket_len", F.floor(rank / fit).cast("long").alias("batch"), (rank % fit).cast("long").alias("slot"), (F.col("bucket_len") - F.col("n_tokens")).alias("padding"),
    )


def op2_length_buckets(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
