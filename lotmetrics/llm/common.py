"""Helpers that the corpus operators share."""

import atexit
import gc
import tempfile
import time
import uuid

import numpy as np
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The characters that separate words, as a class: space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(col: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; null ids have remainder null."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % n


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; where the setting is absent, a temporary one in local mode and an error elsewhere."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = spark.conf.get("spark.lotmetrics.scratch", None)
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="lotmetrics-")
        spark.conf.set("spark.lotmetrics.scratch", found)
    return found.rstrip("/")


def cleared(spark: SparkSession, path: str) -> str:
    """The folder, to be removed when the driver ends."""
    atexit.register(remove, spark, path)
    return path


def free_name(df: DataFrame, name: str) -> str:
    """The name, with underscores until no column has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def distinct_names(keep: tuple[str, ...], made: tuple[str, ...]) -> None:
    """ValueError where a kept column has the name of one that an operator returns."""
    twice = {c.lower() for c in keep} & set(made)
    if twice:
        raise ValueError(f"kept columns differ from those returned: {sorted(twice)}")


def text_and(docs: DataFrame, text: str, keep: tuple[str, ...]) -> DataFrame:
    """The text as binary, under a name that no kept column has, and the kept columns."""
    return docs.select(F.col(text).cast("binary").alias(free_name(docs.select(*keep), "_text")), *keep)


def without(df: DataFrame, keys: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of df whose key is not among the only column of keys; null keys stay."""
    own = free_name(df, "_gone")
    return df.join(keys.toDF(own), F.col(key) == F.col(own), "left_anti")


def slices(batches, rows: int = 512):
    """Arrow batches in slices, so that what Python holds at once stays small."""
    return (b.slice(i, rows) for b in batches for i in range(0, b.num_rows, rows))


def blocks(batches, size: int):
    """Arrow batches in slices whose first column, text as binary, holds about `size` bytes; a longer text is alone."""
    for b in batches:
        held = np.cumsum(pc.fill_null(pc.binary_length(b.column(0)), 0).to_numpy(zero_copy_only=False))
        first = 0
        while first < b.num_rows:
            before = int(held[first - 1]) if first else 0
            last = max(first + 1, int(np.searchsorted(held, before + size, side="right")))
            yield b.slice(first, last - first)
            first = last


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder and read it back: lineage is cut and sizes are known.

    The table outlives lost executors; it is removed when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}-{label}"
    schema = df.schema
    df.write.parquet(cleared(spark, path))
    return spark.read.schema(schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    try:
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
    except Exception:  # the session has ended before
        pass


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def release(spark: SparkSession) -> None:
    """Lets Spark's cleaner delete the shuffle files of finished queries now.

    Twice: the driver's Python lets go of its plans only after the first round.
    """
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.5)
