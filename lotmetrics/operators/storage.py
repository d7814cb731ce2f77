"""Tables that a query writes once and reads often, in the folder that the cluster shares."""

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame


def shared_dir(spark) -> str:
    """The folder that the cluster shares (spark.checkpoint.dir); in local mode a folder of its own where the setting is absent."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.lotmetrics.panels", None)
    if not found:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="lotmetrics-")
        spark.conf.set("spark.lotmetrics.panels", found)
    return found.rstrip("/")


def removed(spark, path: str) -> None:
    try:
        gone = spark._jvm.org.apache.hadoop.fs.Path(path)
        gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)
    except Exception:  # the session has ended before
        pass


def stored(df: DataFrame) -> DataFrame:
    """The frame written once to the shared folder, for panels that a query reads often: its sources are read once, and its size is known.

    The files outlive lost executors and are removed when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/panel-{uuid.uuid4().hex}"
    atexit.register(removed, spark, path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
