"""Language identification by prediction by partial matching.

For each language, a byte context tree of orders 0 to `order` holds the counts
of a bounded sample of its texts (`max_docs` of at most `max_chars` characters
each, both parameters, chosen by the id's hash).  The counts are frozen.  A byte
costs -log2(c / (n + d)) bits in the longest context that knows it, plus
-log2(d / (n + d)) for each longer known context that it escapes from (method
C, without exclusion; n: the context's count, d: its distinct bytes); below
order 0 every byte costs 8 bits.  The language with the shortest exact code
length of the whole text wins, ties going to the first name.

The score is the winner's posterior share under equal priors.  A null text and
one without a letter have `und` and score 0, as has every text when nothing was
learned.  Repeated rows have equal results; an empty table gives no rows.  Texts are
scored whole, whatever their length; columns that are not kept are not read, and
kept ones may have any name but those returned.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import distinct_names, free_name, remainder, table

ORDER = 4
PAD = "\n" * ORDER  #: context before a text's first byte
CHUNK = 1 << 19


def grams(flat: np.ndarray, order: int, at: int, end: int) -> np.ndarray:
    """The order + 1 bytes that end at each of at..end as an integer, the last byte lowest."""
    keys = np.zeros(end - at, dtype=np.uint64)
    for back in range(order, -1, -1):
        keys = keys << np.uint64(8) | flat[at - back : end - back].astype(np.uint64)
    return keys


class Lookup:
    """Key to row number by open addressing, for arrays of keys at once."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.bits = max(4, int(len(keys) * 4).bit_length())
        self.slots = np.full(1 << self.bits, -1, dtype=np.int32)
        at, left = self.place(keys), np.arange(len(keys))
        while len(left):
            free = self.slots[at] < 0
            spots, first = np.unique(at[free], return_index=True)
            placed = np.flatnonzero(free)[first]
            self.slots[spots] = left[placed]
            rest = np.ones(len(left), dtype=bool)
            rest[placed] = False
            left, at = left[rest], (at[rest] + 1) & (len(self.slots) - 1)

    def place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row numbers, -1 for unknown keys."""
        if not len(self.keys):
            return np.full(len(keys), -1, dtype=np.int32)
        at = self.place(keys)
        out = self.slots[at]
        odd = np.flatnonzero((out >= 0) & (self.keys[out] != keys))
        at = at[odd]
        while len(odd):
            at = (at + 1) & (len(self.slots) - 1)
            out[odd] = got = self.slots[at]
            more = (got >= 0) & (self.keys[got] != keys[odd])
            odd, at = odd[more], at[more]
        return out


class Trees:
    """The frozen trees of all languages: code lengths by order, for every known byte after every known context."""

    def __init__(self, samples: dict[str, list[str]], order: int = ORDER):
        self.langs, self.order, self.known, self.bits, self.contexts, self.escapes = sorted(samples), order, [], [], [], []
        flats, own = [], []
        for x in self.langs:
            parts = [(PAD + t).encode("utf-8", "surrogatepass") for t in samples[x]]
            flats.append(np.frombuffer(b"".join(parts), dtype=np.uint8))
            # the padding is context, not text
            ends = np.cumsum([len(p) for p in parts])
            inside = np.ones(len(flats[-1]), dtype=bool)
            for begin in [0, *ends[:-1]]:
                inside[begin : begin + ORDER] = False
            own.append(inside[order:])
        for k in range(order + 1):
            counts = [np.unique(grams(f, k, order, len(f))[o], return_counts=True) for f, o in zip(flats, own, strict=True)]
            keys = np.unique(np.concatenate([u for u, _ in counts])) if counts else np.zeros(0, dtype=np.uint64)
            contexts = np.unique(keys >> np.uint64(8))
            escape = np.zeros((len(contexts), len(self.langs)))
            bits = np.empty((len(keys), len(self.langs)))
            of_key = np.searchsorted(contexts, keys >> np.uint64(8))
            lower = self.cost(k - 1, keys & np.uint64((1 << 8 * k) - 1)) if len(keys) else bits
            for j, (u, c) in enumerate(counts):
                of = np.searchsorted(contexts, u >> np.uint64(8))
                n, d = np.bincount(of, c, len(contexts)), np.bincount(of, minlength=len(contexts))
                with np.errstate(divide="ignore", invalid="ignore"):
                    escape[:, j] = np.where(d > 0, -np.log2(d / (n + d)), 0)
                bits[:, j] = escape[of_key, j] + lower[:, j]
                bits[np.searchsorted(keys, u), j] = -np.log2(c / (n[of] + d[of]))
            self.known.append(Lookup(keys))
            self.bits.append(bits.astype(np.float32))
            self.contexts.append(Lookup(contexts))
            self.escapes.append(escape.astype(np.float32))

    def cost(self, k: int, keys: np.ndarray) -> np.ndarray:
        """Bits of each key's last byte after the k bytes before it, by language."""
        if k < 0:
            return np.full((len(keys), len(self.langs)), 8, dtype=np.float32)
        row = self.known[k].find(keys)
        out = self.bits[k][row] if len(self.bits[k]) else np.zeros((len(keys), len(self.langs)), dtype=np.float32)
        if len(miss := np.flatnonzero(row < 0)):
            other = self.cost(k - 1, keys[miss] & np.uint64((1 << 8 * k) - 1))
            context = self.contexts[k].find(keys[miss] >> np.uint64(8))
            inside = context >= 0
            other[inside] += self.escapes[k][context[inside]]
            out[miss] = other
        return out

    def lengths(self, flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Code lengths in bits of the texts that begin, after their padding, at starts (ascending) of flat."""
        out = np.zeros((len(starts), len(self.langs)))
        if not len(starts):
            return out
        skip = np.zeros(len(flat), dtype=bool)
        for k in range(self.order):
            skip[starts + k] = True
        for at in range(int(starts[0]) + self.order, len(flat), CHUNK):
            end = min(at + CHUNK, len(flat))
            cost = self.cost(self.order, grams(flat, self.order, at, end))
            cost[skip[at:end]] = 0
            first = int(np.searchsorted(starts, at, "right")) - 1
            inner = starts[first + 1 : np.searchsorted(starts, end, "left")]
            out[first : first + 1 + len(inner)] += np.add.reduceat(cost, np.concatenate([[0], inner - at]), axis=0, dtype=np.float64)
        return out


def fit(docs: DataFrame, max_docs: int = 200, max_chars: int = 20_000) -> Trees | None:
    """docs: doc_id, text, lang. The sample goes to the driver: at most max_docs * max_chars characters a language."""
    known = docs.where(F.col("lang").isNotNull() & F.length("text").between(1, max_chars))
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    u = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("sample")), F.lit(1 << 20)) / float(1 << 20)
    share = F.lit(1.0)
    for lang, n in sorted(counts.items()):
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, max_docs / n))).otherwise(share)
    samples: dict[str, list] = {x: [] for x in counts}
    for r in known.where(u < share).select("lang", "doc_id", "text").collect():
        samples[r["lang"]].append((r["doc_id"], r["text"]))
    ordered = {x: [t for _, t in sorted(v, key=lambda y: (y[0] is None, y[0] or 0, y[1]))][: 2 * max_docs] for x, v in samples.items()}
    return Trees({x: v for x, v in ordered.items() if v})


def predict(docs: DataFrame, trees: Trees | None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns keep, lang_pred and score; ValueError if a kept column has one of these names."""
    distinct_names(keep, ("lang_pred", "score"))
    read = F.col("text").isNotNull() & F.col("text").rlike(r"\p{L}")
    rows = docs.select(F.when(read, F.concat(F.lit(PAD), "text")).alias(free_name(docs.select(*keep), "_text")), *keep)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:])

    def scored(batches):
        for b in batches:
            text = b.column(0)
            if text.null_count < len(text) and trees is not None:
                full = text.drop_null().cast(pa.large_binary())
                offsets = np.frombuffer(full.buffers()[1], dtype=np.int64)[full.offset : full.offset + len(full) + 1]
                flat = np.frombuffer(full.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
                bits = trees.lengths(flat, offsets[:-1] - offsets[0])
                best = bits.argmin(axis=1)
                share = 1 / np.exp2(bits.min(axis=1, keepdims=True) - bits).sum(axis=1)
            langs, scores, k = [], [], 0
            for valid in text.is_valid().to_pylist():
                ok = valid and trees is not None
                langs.append(trees.langs[best[k]] if ok else "und")
                scores.append(float(share[k]) if ok else 0.0)
                k += valid
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*b.schema.names[1:], "lang_pred", "score"])

    return rows.mapInArrow(scored, f"{fields}, lang_pred string, score double")


def op3_partial_matching(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    trees = fit(docs.where(remainder("doc_id", 5) != 0))
    rows = docs.select("doc_id", "text", (F.coalesce(remainder("doc_id", 5), F.lit(-1)) == 0).alias("held_out"))
    return predict(rows, trees, ("doc_id", "held_out"))
