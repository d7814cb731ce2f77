"""Quality by compression: zstandard dictionaries of good and of bad text.

Two dictionaries are trained from a bounded sample of labelled texts (at most
`max_docs` of each label, of at most `max_chars` characters each, both
parameters, chosen by the id's hash).  A text is compressed in blocks of 1 KB
with either; the normalised difference of the sizes, (good - bad) / (good +
bad), becomes a score by a logistic calibration fitted on labelled texts that
the dictionaries did not see, and the score is the chance of label 1.

Null and empty texts have difference 0 and the score that the calibration gives
it.  Repeated labels count each; null labels and labels of unknown documents
count nothing.  Without labels of both kinds every score is the share of label 1
(0.5 without any).  Repeated rows have equal scores; no rows give none.  Very long texts
are compressed whole, block by block.
"""

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import remainder, table

BLOCK = 1024


class Model:
    """Dictionaries and calibration; small, so that it travels with the function."""

    def __init__(self, good: bytes, bad: bytes, slope: float, offset: float):
        self.good, self.bad, self.slope, self.offset = good, bad, slope, offset
        self.ready = None

    def __getstate__(self):
        return (self.good, self.bad, self.slope, self.offset)

    def __setstate__(self, x):
        self.__init__(*x)

    def difference(self, text: str | None) -> float:
        if not text or not self.good:
            return 0.0
        if self.ready is None:
            self.ready = [zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(x, dict_type=zstandard.DICT_TYPE_AUTO), write_content_size=False, write_dict_id=False) for x in (self.good, self.bad)]
        raw = memoryview(text.encode("utf-8", "surrogatepass"))
        a, b = (sum(len(c.compress(raw[i : i + BLOCK])) for i in range(0, len(raw), BLOCK)) for c in self.ready)
        return (a - b) / (a + b)

    def score(self, text: str | None) -> float:
        x = self.slope * self.difference(text) + self.offset
        return float(1 / (1 + np.exp(-np.clip(x, -30, 30))))


def calibrate(x: np.ndarray, y: np.ndarray, ridge: float = 1e-6) -> tuple[float, float]:
    """Logistic regression of y on x by Newton steps; classes weigh as they occur."""
    scale = float(np.std(x)) or 1.0
    a = np.column_stack([x / scale, np.ones(len(x))])
    w = np.zeros(2)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + ridge * len(x) * np.eye(2), a.T @ (y - p) - ridge * len(x) * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / scale), float(w[1])


def dictionary(texts: list[str], size: int) -> bytes:
    """zstandard's trained dictionary with its entropy tables; where the trainer finds too little, the texts' last parts as plain content."""
    blocks = [raw[i : i + BLOCK] for t in texts if (raw := t.encode("utf-8", "surrogatepass")) for i in range(0, len(raw), BLOCK)]
    try:
        made = zstandard.train_dictionary(size, blocks).as_bytes()
    except zstandard.ZstdError:
        made = b"".join(blocks)[-size:]
    return made


def fit(docs: DataFrame, labels: DataFrame, max_docs: int = 2500, max_chars: int = 20_000, size: int = 400_000) -> Model:
    """docs: doc_id, text; labels: doc_id, quality. The sample goes to the driver: at most 2 * max_docs * max_chars characters."""
    known = labels.select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("_y")).where("_id is not null and _y in (0, 1)")
    counts = {r["_y"]: r["n"] for r in known.groupBy("_y").agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    share = (counts.get(1, 0) + 0.5) / (total + 1) if total else 0.5
    blank = Model(b"", b"", 0.0, float(np.log(share / (1 - share))))
    if len(counts) < 2:
        return blank
    some = None
    for y in (0, 1):
        best = known.where(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(max_docs)
        some = best if some is None else some.unionByName(best)
    rows = docs.select("doc_id", "text").where(F.length("text").between(1, max_chars)).join(F.broadcast(some), F.col("doc_id") == F.col("_id")).select("_y", "_id", "text").collect()
    rows = sorted(rows, key=lambda r: (r["_id"], r["text"], r["_y"]))
    by = {y: [r["text"] for r in rows if r["_y"] == y] for y in (0, 1)}
    if min(len(by[0]), len(by[1])) < 4:
        return blank
    model = Model(*(dictionary(by[y][::2], size) for y in (1, 0)), 0.0, 0.0)
    held = [(model.difference(t), y) for y in (0, 1) for t in by[y][1::2]]
    x, y = np.array([a for a, _ in held]), np.array([b for _, b in held], dtype=float)
    model.slope, model.offset = calibrate(x, y)
    # the sample is balanced up to max_docs: shift to the labels' own shares
    n1, n0 = max(1, int(y.sum())), max(1, int((1 - y).sum()))
    model.offset += float(np.log(counts[1] / counts[0]) - np.log(n1 / n0))
    return model


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """docs with the score; extra columns stay, but for one named as the score, which it replaces."""
    docs = docs.drop(out)
    place = docs.columns.index(text)

    def scored(batches):
        for b in batches:
            yield b.append_column(out, pa.array([model.score(t) for t in b.column(place).to_pylist()], pa.float64()))

    return docs.mapInArrow(scored, StructType([*docs.schema.fields, StructField(out, DoubleType())]))


def accepted(score: Column, threshold: float = 0.7) -> Column:
    return score >= threshold


def op8_compression_classifier(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(remainder("doc_id", 4) != 2), table(spark, sf_dir, "labels").where(remainder("doc_id", 4) != 2))
    rows = score(docs.select("doc_id", "text"), model)
    return rows.select("doc_id", (F.coalesce(remainder("doc_id", 4), F.lit(-1)) == 2).alias("held_out"), "score", accepted(F.col("score")).cast("int").alias("predicted"))
