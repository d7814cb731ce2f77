"""The corpus pipeline: quality, near copies, benchmark passages, personal data, packing.

Each stage takes all rows that its predecessor kept and returns the columns of
documents, the last one the packed batches.

Null and empty texts have the quality score of an empty text and go or stay by
it.  Rows of a null id are never near copies nor contaminated.  Repeated rows
have equal scores; rows that share an id stay or go together.  Extra columns of
any name are kept up to packing, which returns its own.  No documents give no
rows.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotmetrics.llm import op2_packing, op5_pii, op6_simhash, op8_quality, op10_decontaminate
from lotmetrics.llm.common import free_name, materialize, remainder, table, without


def quality(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches the threshold stay."""
    labels = table(spark, sf_dir, "labels").where(remainder("doc_id", 4) != 2)
    model = op8_quality.fit(docs.where(remainder("doc_id", 4) != 2), labels)
    own = free_name(docs, "_score")
    return op8_quality.score(docs, model, out=own).where(op8_quality.accepted(F.col(own))).drop(own)


def near_copies(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id."""
    return op6_simhash.drop_near_copies(docs)


def decontaminate(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    found = op10_decontaminate.contained_items(docs, table(spark, sf_dir, "benchmark"))
    return without(docs, materialize(found.select("doc_id").distinct(), "contaminated"))


def personal_data(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; n_chars follows the text."""
    masked = op5_pii.redact_pii(docs)
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return masked


def packing(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op2_packing.pack(docs)


STAGES = [("quality_classifier", quality), ("simhash_near_dedup", near_copies), ("benchmark_decontamination", decontaminate), ("pii", personal_data), ("packing", packing)]
#: Compression and fingerprints are beyond SQL; a test holds run() against brute force.
ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = materialize(docs, name)
    return docs
