"""Line dedup by a sharded minimal perfect hash over line hashes.

1. A line's key is the line without white space at its ends, A to Z lower-cased; its
   hash has 128 bits.  Each task counts the documents of its keys before the
   shuffle; 20 bytes a key travel, no lines.
2. The distinct hashes found in at least `least` documents are dealt to shards of
   about `keys` hashes.  A shard becomes a minimal perfect hash by levels of bits
   (a key that is alone at its place of a level sets the bit, the others go on
   to the next level; a key's number is the rank of its bit) of about 3.7 bits a
   key, an array of fingerprints (64 other bits of the hash) and one of counts, as
   narrow as the largest allows.  `least` = 1 indexes every distinct line; for
   dropping lines, those in fewer documents than the threshold need no place, as
   their fingerprints tell them from the others.
3. Documents probe the arrays: a task reads about `block` bytes of texts, sorts the
   hashes of their lines by shard and loads one shard after the other from the
   shared folder, `cache` bytes of them staying in memory.  No line is joined or
   shuffled again.  A line that is not in the index is taken for one with a chance
   of 2^-64.

Null and empty texts have one empty line, which has no key and stays.  Very long
texts and lines are processed whole.  Each row is a document of its own, also when
ids repeat or are null.  Columns in `keep` may have any name but those that the
operator returns, which raises ValueError.  An empty table gives no rows.  Lost
executors: the index is a Parquet table in the shared folder, one file a shard.
"""

import io
import math
import uuid
from collections import OrderedDict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, cleared, materialize, shared_dir, table, text_and
from .op7_repeats import ODD, mixed

SPACE = b" \t\n\x0b\x0c\r"
#: Different keys whose counts a task holds at once.
HELD = 200_000
#: Places of a level for each key that reaches it.
ROOM = 2.0


def keys_of(text: bytes | None, min_chars: int) -> list[bytes | None]:
    """The key of each line; None for one that is too short to have one."""
    found = [line.strip(SPACE) for line in (text or b"").lower().split(b"\n")]
    return [k if len(k) >= min_chars and (min_chars == 1 or len(k.decode("utf-8", "replace")) >= min_chars) else None for k in found]


def halves(digests: list[bytes]) -> np.ndarray:
    """Rows of two 64-bit numbers."""
    return np.frombuffer(b"".join(digests), dtype="<u8").reshape(-1, 2)


def key_counts(docs: DataFrame, min_chars: int = 1, text: str = "text", block: int = 4 << 20) -> DataFrame:
    """low, high (the hash of a key), n (documents that have it)."""

    def count(batches):
        held: dict[bytes, int] = {}

        def out():
            pair = halves(list(held)).view("<i8")
            return pa.RecordBatch.from_arrays([pa.array(pair[:, 0]), pa.array(pair[:, 1]), pa.array(list(held.values()), pa.int64())], names=["low", "high", "n"])

        for b in blocks(batches, block):
            for t in b.column(0).to_pylist():
                for d in {xxhash.xxh3_128_digest(k) for k in keys_of(t, min_chars) if k is not None}:
                    held[d] = held.get(d, 0) + 1
                if len(held) >= HELD:
                    yield out()
                    held.clear()
        yield out()

    rows = docs.select(F.col(text).cast("binary").alias("_text")).mapInArrow(count, "low long, high long, n long")
    return rows.groupBy("low", "high").agg(F.sum("n").alias("n"))


def places(low: np.ndarray, high: np.ndarray, level: int, size: int) -> np.ndarray:
    h = mixed(mixed(low + np.uint64(level * ODD % (1 << 64))) ^ high)
    return ((h >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)


class PerfectHash:
    """Numbers n distinct keys from 0 to n - 1."""

    def __init__(self, sizes: np.ndarray, words: np.ndarray):
        self.sizes, self.words = sizes, words
        ones = np.cumsum(np.bitwise_count(words), dtype=np.int64)
        self.before = np.concatenate([[0], ones[:-1]]) if len(words) else ones

    @classmethod
    def of(cls, low: np.ndarray, high: np.ndarray) -> "PerfectHash":
        sizes, bits, left = [], [], np.arange(len(low))
        while len(left):
            if len(sizes) == 64:
                raise ValueError("keys are not distinct")
            size = max(64, math.ceil(ROOM * len(left) / 64) * 64)
            at = places(low[left], high[left], len(sizes), size)
            n = np.bincount(at, minlength=size)
            bits.append(np.packbits(n == 1, bitorder="little"))
            sizes.append(size)
            left = left[n[at] != 1]
        return cls(np.array(sizes, dtype=np.int64), np.concatenate(bits).view("<u8") if bits else np.zeros(0, dtype="<u8"))

    def number(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The keys' numbers; any number or -1 for what is no key."""
        out, left, begin = np.full(len(low), -1, dtype=np.int64), np.arange(len(low)), 0
        for level, size in enumerate(self.sizes.tolist()):
            at = begin + places(low[left], high[left], level, size)
            bit = (at & 63).astype(np.uint64)
            word = self.words[at >> 6]
            hit = (word >> bit & np.uint64(1)).astype(bool)
            here = word & ((np.uint64(1) << bit) - np.uint64(1))
            out[left[hit]] = (self.before[at >> 6] + np.bitwise_count(here))[hit]
            left, begin = left[~hit], begin + size
        return out


@dataclass
class Shard:
    hashed: PerfectHash
    prints: np.ndarray
    counts: np.ndarray

    @classmethod
    def of(cls, low: np.ndarray, high: np.ndarray, n: np.ndarray) -> "Shard":
        hashed = PerfectHash.of(low, high)
        at = hashed.number(low, high)
        narrow = np.min_scalar_type(int(n.max())) if len(n) else np.dtype("u1")
        prints, counts = np.empty(len(n), dtype="<u8"), np.empty(len(n), dtype=narrow.newbyteorder("<"))
        prints[at], counts[at] = high, n
        return cls(hashed, prints, counts)

    def count(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The counts of the hashes, 0 for those that are not here."""
        if not len(self.prints):
            return np.zeros(len(low), dtype=np.int64)
        at = self.hashed.number(low, high)
        return np.where((at >= 0) & (self.prints[at] == high), self.counts[at], 0).astype(np.int64)

    @property
    def size(self) -> int:
        return sum(x.nbytes for x in (self.hashed.words, self.hashed.before, self.prints, self.counts))


@dataclass
class Index:
    """Where the shards lie. Small: it travels with the functions that probe."""

    path: str
    shards: int
    keys: int
    least: int
    min_chars: int

    def load(self, shard: int) -> Shard | None:
        """None where no key fell into the shard."""
        fs, root = pyarrow.fs.FileSystem.from_uri(f"{self.path}/shard={shard}")
        found = [f.path for f in fs.get_file_info(pyarrow.fs.FileSelector(root, allow_not_found=True)) if f.path.endswith(".parquet")]
        if not found:
            return None
        with fs.open_input_file(found[0]) as f:
            row = pq.read_table(io.BytesIO(f.read())).to_pylist()[0]
        return Shard(PerfectHash(np.frombuffer(row["sizes"], dtype="<i8"), np.frombuffer(row["words"], dtype="<u8")), np.frombuffer(row["prints"], dtype="<u8"), np.frombuffer(row["counts"], dtype=row["kind"]))


class Prober:
    """Counts of hashes, with the shards used last in memory."""

    def __init__(self, index: Index, cache: int):
        self.index, self.cache, self.held, self.size = index, cache, OrderedDict(), 0

    def shard(self, k: int) -> Shard | None:
        if k not in self.held:
            got = self.held[k] = self.index.load(k)
            self.size += got.size if got else 0
            while self.size > self.cache and len(self.held) > 1:
                gone = self.held.popitem(last=False)[1]
                self.size -= gone.size if gone else 0
        self.held.move_to_end(k)
        return self.held[k]

    def counts(self, pairs: np.ndarray) -> np.ndarray:
        out = np.zeros(len(pairs), dtype=np.int64)
        if not self.index.keys or not len(pairs):
            return out
        low, high = pairs[:, 0], pairs[:, 1]
        own = low.view("<i8") % self.index.shards if low.flags.c_contiguous else np.ascontiguousarray(low).view("<i8") % self.index.shards
        order = np.argsort(own, kind="stable")
        cuts = np.flatnonzero(np.diff(own[order], prepend=-1))
        for a, b in zip(cuts, [*cuts[1:], len(order)], strict=True):
            at = order[a:b]
            shard = self.shard(int(own[at[0]]))
            if shard is not None:
                out[at] = shard.count(low[at], high[at])
        return out


def index_lines(docs: DataFrame, least: int = 1, min_chars: int = 1, keys: int = 500_000, text: str = "text") -> Index:
    """The index of all keys found in at least `least` documents."""
    spark = docs.sparkSession
    if min_chars < 1 or least < 1:
        raise ValueError("min_chars and least are at least 1")
    counted = materialize(key_counts(docs, min_chars, text).where(F.col("n") >= least), "line-counts")
    total = counted.count()
    shards = max(1, math.ceil(total / keys))

    def build(group: pa.Table) -> pa.Table:
        low, high = (group.column(c).to_numpy().view("<u8") for c in ("low", "high"))
        made = Shard.of(low, high, group.column("n").to_numpy())
        one = {"shard": group.column("shard")[0].as_py(), "sizes": made.hashed.sizes.tobytes(), "words": made.hashed.words.tobytes(), "prints": made.prints.tobytes(), "counts": made.counts.tobytes(), "kind": made.counts.dtype.str}
        return pa.Table.from_pylist([one], schema=pa.schema([("shard", pa.int64()), *[(c, pa.binary()) for c in ("sizes", "words", "prints", "counts")], ("kind", pa.string())]))

    path = cleared(spark, f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}-line-index")
    made = counted.withColumn("shard", F.pmod("low", F.lit(shards))).groupBy("shard").applyInArrow(build, "shard long, sizes binary, words binary, prints binary, counts binary, kind string")
    made.write.partitionBy("shard").parquet(path)
    return Index(path, shards, total, least, min_chars)


def drop_lines(docs: DataFrame, index: Index, min_docs: int, text: str = "text", keep: tuple[str, ...] = ("doc_id",), block: int = 16 << 20, cache: int = 128 << 20) -> DataFrame:
    """The columns keep, n_lines, n_dropped, kept (the other lines, joined): lines whose keys `min_docs` documents have go."""
    names = ["n_lines", "n_dropped", "kept"]
    if min_docs < index.least or {c.lower() for c in keep} & set(names):
        raise ValueError("min_docs is at least the index's `least`, and kept columns differ from those returned")
    rows = text_and(docs, text, keep)

    def probe(batches):
        prober = Prober(index, cache)
        for b in blocks(batches, block):
            texts = b.column(0).to_pylist()
            digests, owners = [], []
            for i, t in enumerate(texts):
                for j, k in enumerate(keys_of(t, index.min_chars)):
                    if k is not None:
                        digests.append(xxhash.xxh3_128_digest(k))
                        owners.append((i, j))
            goes: dict[int, set[int]] = {}
            for at in np.flatnonzero(prober.counts(halves(digests)) >= min_docs).tolist():
                goes.setdefault(owners[at][0], set()).add(owners[at][1])
            lines, dropped, kept = [], [], []
            for i, t in enumerate(texts):
                gone = goes.get(i, ())
                lines.append((t or b"").count(b"\n") + 1)
                dropped.append(len(gone))
                kept.append(b"\n".join(x for j, x in enumerate(t.split(b"\n")) if j not in gone) if gone else t or b"")
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(lines, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.binary())], names=[*b.schema.names[1:], *names])

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[1:])
    return rows.mapInArrow(probe, f"{fields}n_lines long, n_dropped long, kept binary").withColumn("kept", F.col("kept").cast("string"))


#: Documents from which a line goes.
MIN_DOCS = 10


def op13_common_lines(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = drop_lines(docs, index_lines(docs, least=MIN_DOCS), MIN_DOCS)
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


SQL = f"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
line AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS nth FROM split),
keyed AS (SELECT *, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key FROM line),
common AS (SELECT key FROM (SELECT DISTINCT doc_id, key FROM keyed WHERE key <> '') GROUP BY key HAVING count(*) >= {MIN_DOCS}),
judged AS (SELECT k.doc_id, k.line, k.nth, c.key IS NOT NULL AS goes FROM keyed k LEFT JOIN common c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE goes) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY nth) FILTER (WHERE NOT goes), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
