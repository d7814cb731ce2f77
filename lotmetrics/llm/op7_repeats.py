"""Repeated byte strings: removes what an earlier document already has.

A byte goes if a string of `length` bytes covers it that also starts in a
document with a smaller id.  The suffix order behind it is sparse, induced and
external:

1. Every window of `length` bytes is represented by the leftmost of its smallest
   hashed grams of `gram` bytes (its anchor).  Equal windows have their anchor at
   the same offset, so only anchors that occur in two documents are kept; they
   meet by a sort on disk.
2. Around each kept anchor a document sends one row to the anchor's shard: the
   suffix from the anchor on and the bytes before it, in reverse.  Rows of equal
   bytes are combined before the shuffle: only the smallest id travels, for the
   others all windows of the row are repeated.
3. A shard is sorted by the anchors' suffixes (Spark's external sort).  The order
   of the suffixes that begin one byte earlier is induced from it, and so on
   recursively: suffix tuples with their common-prefix values go into a priority
   queue by the byte before them and leave it in order.  Neighbours that share
   `length` bytes are equal windows; the smallest id of each such group decides.
   Tuples that no later step can make equal leave early.  A queue holds `budget`
   bytes in memory and keeps the rest in files of the shared folder.
4. The repeated windows' union is cut out of each document.

Documents that are whole copies of an earlier one skip step 2: all of it goes.

Null texts are empty; texts shorter than `length` keep all.  A null id is never
smaller and its document stays whole.  Rows that share an id do not repeat each
other; each is judged against smaller ids.  Other columns are not read, whatever
their names.  An empty table gives no rows.
"""

import hashlib
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cleared, materialize, release, shared_dir, slices, table

ODD = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(ODD, -1, 1 << 64)
#: Bits of a position in a list of pieces.
PLACE = 20
NEVER = np.iinfo(np.int64).max


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    for _ in range(2):
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
    return h


class Hasher:
    """Hashes of all runs of k bytes of an array, by prefix sums of powers modulo 2^64."""

    def __init__(self):
        self.up, self.down = powers(ODD, 0), powers(INVERSE, 0)

    def __call__(self, flat: np.ndarray, k: int) -> np.ndarray:
        n = len(flat)
        if n < k:
            return np.zeros(0, dtype=np.uint64)
        if len(self.up) < n:
            self.up, self.down = powers(ODD, 2 * n), powers(INVERSE, 2 * n)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((flat.astype(np.uint64) + np.uint64(1)) * self.up[:n], out=sums[1:])
        return mixed((sums[k:] - sums[:-k]) * self.down[: n - k + 1])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    return np.minimum(values[: len(values) - (width - span)], values[width - span :]) if span < width else values


def pieces(texts: list[bytes], length: int, block: int = 1 << 18):
    """Lists of (document number, offset, bytes) of about block bytes; long texts in overlapping pieces, each window in one."""
    got, size = [], 0
    for i, t in enumerate(texts):
        for at in range(0, len(t) - length + 1, block):
            part = memoryview(t)[at : at + block + length - 1]
            got.append((i, at, part))
            size += len(part)
            if size >= block:
                yield got
                got, size = [], 0
    if got:
        yield got


def anchors(got: list, length: int, gram: int, hasher: Hasher) -> tuple[np.ndarray, ...]:
    """Of a list of pieces: all bytes; each valid window's start, piece, anchor hash and anchor position."""
    flat = np.frombuffer(b"".join(p for _, _, p in got), dtype=np.uint8)
    sizes = np.array([len(p) for _, _, p in got])
    grams = hasher(flat, gram)
    places = np.uint64((1 << PLACE) - 1)
    # the smallest hash and, among equal ones, the leftmost
    low = sliding_min((grams & ~places) | np.arange(len(grams), dtype=np.uint64), length - gram + 1)
    piece = np.repeat(np.arange(len(got), dtype=np.int32), sizes)[: len(low)]
    at = np.flatnonzero(np.arange(len(low)) <= (np.cumsum(sizes) - length)[piece])
    pos = (low[at] & places).astype(np.int64)
    return flat, at, piece[at], grams[pos], pos


def runs(*columns: np.ndarray) -> np.ndarray:
    """Where a run of equal rows begins."""
    n = len(columns[0])
    new = np.ones(n, dtype=bool)
    if n:
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(new)


def raw(values: list) -> list[bytes]:
    return [x.encode("utf-8", "surrogatepass") if x else b"" for x in values]


def shared_anchors(batches):
    """From (h, doc_id) in order, the rows of each h that has two ids."""
    last_h = last_doc = None
    told = False
    for b in batches:
        if not b.num_rows:
            continue
        h, doc = (b.column(c).to_numpy() for c in ("h", "doc_id"))
        carried = last_h is not None
        if carried:
            h, doc = np.concatenate([[last_h], h]), np.concatenate([[last_doc], doc])
        begin = runs(h)
        sizes = np.diff(np.append(begin, len(h)))
        first = np.repeat(doc[begin], sizes)
        many = np.logical_or.reduceat(doc != first, begin)
        if carried and told:
            many[0] = True
        keep = np.repeat(many, sizes)
        last_h, last_doc = h[-1], first[-1]
        still = bool(many[-1])
        if carried and told:
            keep[0] = False
        told = still
        # an id that came twice counts once; the first of an undecided group waits in the carry
        twice = np.zeros(len(h), dtype=bool)
        twice[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
        keep &= ~twice
        yield pa.RecordBatch.from_arrays([pa.array(doc[keep]), pa.array(h[keep])], names=["doc_id", "h"])


def fixed(matrix: np.ndarray) -> pa.Array:
    """The rows of a matrix of bytes."""
    n, width = matrix.shape
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), n, [None, pa.py_buffer(np.ascontiguousarray(matrix))]).cast(pa.binary())


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, width)


SNIPPETS = "h int, doc_id long, key long, at long, last long, low short, high short, back binary, tail binary"


class Combiner:
    """Rows around anchors; those of equal bytes that meet here are sent once.

    A row stands for the windows that have their anchor `low` to `high` bytes
    after their start, with anchors at `at` to `last` in steps of `length` or
    less (a periodic text is one row).  Rows without bytes tell a repeated
    stretch, from `at` to `last`.
    """

    def __init__(self, length: int, gram: int, rows: int = 1 << 15):
        self.length, self.reach, self.rows = length, length - gram, rows
        self.held: list[tuple] = []
        self.size = 0

    def add(self, flat: np.ndarray, h: np.ndarray, doc: np.ndarray, key: np.ndarray, at: np.ndarray, pos: np.ndarray, low: np.ndarray, high: np.ndarray):
        padded = np.concatenate([np.zeros(self.reach, dtype=np.uint8), flat, np.zeros(self.length, dtype=np.uint8)])
        body = np.lib.stride_tricks.sliding_window_view(padded, self.reach + self.length)[pos]
        back, tail = body[:, : self.reach][:, ::-1].copy(), body[:, self.reach :].copy()
        back[np.arange(self.reach) >= high[:, None]] = 0
        tail[np.arange(self.length) >= self.length - low[:, None]] = 0
        self.held.append((h, doc, key, at, low, high, back, tail))
        self.size += len(h)
        if self.size >= self.rows:
            yield from self.flush()

    def flush(self):
        if not self.size:
            return
        h, doc, key, at, low, high, back, tail = (np.concatenate(x) for x in zip(*self.held, strict=True))
        self.held, self.size = [], 0
        body = np.concatenate([back, tail, low[:, None].astype(np.uint8), high[:, None].astype(np.uint8)], axis=1)
        body = np.concatenate([body, np.zeros((len(body), -body.shape[1] % 8), dtype=np.uint8)], axis=1)
        words = body.view(np.uint64)
        name = mixed((words * powers(ODD, words.shape[1] + 1)[1:]).sum(axis=1, dtype=np.uint64))
        order = np.lexsort((at, key, doc, name))
        name, doc, key, at, words = name[order], doc[order], key[order], at[order], words[order]
        begin = runs(name)
        lead = np.repeat(begin, np.diff(np.append(begin, len(name))))
        alike = (words == words[lead]).all(axis=1)  # else two contents of one hash: each row travels
        new = np.ones(len(name), dtype=bool)
        new[1:] = (name[1:] != name[:-1]) | (doc[1:] != doc[:-1]) | (key[1:] != key[:-1]) | ~alike[1:] | ~alike[:-1] | (at[1:] - at[:-1] > self.length)
        first = np.flatnonzero(new)
        last = at[np.append(first[1:], len(at)) - 1]
        done = alike[first] & (doc[first] > doc[lead[first]])
        h, low, high, back, tail = (x[order[first]] for x in (h, low, high, back, tail))
        doc, key, at = doc[first], key[first], at[first]
        go = ~done
        shard = (h >> np.uint64(32)).astype(np.uint32).view(np.int32)
        names = [x.rpartition(" ")[0] for x in SNIPPETS.split(", ")]
        numbers = lambda own, *x: [pa.array(shard[own]), *[pa.array(c[own]) for c in x]]
        yield pa.RecordBatch.from_arrays([*numbers(go, doc, key, at, last, low, high), fixed(back[go]), fixed(tail[go])], names=names)
        shard = mixed(doc.view(np.uint64)).astype(np.uint32).view(np.int32)
        none = pa.nulls(int(done.sum()), pa.binary())
        yield pa.RecordBatch.from_arrays([*numbers(done, doc, key, at - high, last - low + self.length, low, high), none, none], names=names)


class BucketQueue:
    """A priority queue by one byte, first in first out within a byte, beyond `budget` bytes on disk.

    Where spool is None all stays in memory.
    """

    def __init__(self, kind: np.dtype, spool: str | None, budget: int):
        self.kind, self.spool, self.budget = kind, spool, budget
        self.memory: dict[int, list[np.ndarray]] = {}
        self.disk: dict[int, list[tuple[str, int, int]]] = {}
        self.files: list[str] = []
        self.size = 0

    def store(self) -> tuple[pa.fs.FileSystem, str]:
        return pa.fs.FileSystem.from_uri(self.spool)

    def push(self, byte: int, rows: np.ndarray) -> None:
        self.memory.setdefault(byte, []).append(rows)
        self.size += rows.nbytes
        if self.size > self.budget and self.spool is not None:
            self.spill()

    def spill(self) -> None:
        fs, folder = self.store()
        fs.create_dir(folder, recursive=True)
        path = f"{folder}/{uuid.uuid4().hex}"
        self.files.append(path)
        with fs.open_output_stream(path) as out:
            for byte, held in self.memory.items():
                rows = np.concatenate(held)
                self.disk.setdefault(byte, []).append((path, out.tell(), len(rows)))
                out.write(rows.tobytes())
        self.memory, self.size = {}, 0

    def segments(self, rows: int):
        opened: dict = {}
        try:
            for byte in sorted(self.disk.keys() | self.memory.keys()):
                for path, at, n in self.disk.get(byte, ()):
                    if path not in opened:
                        opened[path] = self.store()[0].open_input_file(path)
                    for k in range(0, n, rows):
                        take = min(rows, n - k)
                        yield np.frombuffer(opened[path].read_at(take * self.kind.itemsize, at + k * self.kind.itemsize), dtype=self.kind)
                yield from self.memory.get(byte, ())
        finally:
            for f in opened.values():
                f.close()

    def blocks(self, rows: int):
        """All rows in order, in blocks of about `rows`; can be read again."""
        held, n = [], 0
        for part in self.segments(rows):
            held.append(part)
            n += len(part)
            if n >= rows:
                yield np.concatenate(held)
                held, n = [], 0
        if n:
            yield np.concatenate(held)

    def close(self) -> None:
        for path in self.files:
            self.store()[0].delete_file(path)
        self.files, self.memory, self.disk, self.size = [], {}, {}, 0


class Shard:
    """Orders the suffixes of a shard by induction and tells the repeated stretches."""

    def __init__(self, length: int, gram: int, spool: str | None = None, budget: int = 24 << 20, rows: int = 1 << 15):
        self.length, self.reach, self.spool, self.budget, self.rows = length, length - gram, spool, budget, rows
        self.kind = np.dtype([("doc", "<i8"), ("key", "<i8"), ("at", "<i8"), ("last", "<i8"), ("hits", "<u8"), ("low", "u1"), ("high", "u1"), ("lcp", "u1"), ("back", "u1", (self.reach,))])

    def queue(self) -> BucketQueue:
        return BucketQueue(self.kind, self.spool, self.budget)

    def __call__(self, batches):
        """batches: rows of SNIPPETS in order of tail. Yields (doc, key, start, end) arrays."""
        queue, before = self.queue(), None
        try:
            for b in batches:
                told = b.filter(b.column("tail").is_null())
                if told.num_rows:
                    yield tuple(told.column(c).to_numpy() for c in ("doc_id", "key", "at", "last"))
                b = b.filter(b.column("tail").is_valid())
                if not b.num_rows:
                    continue
                tail = matrix(b.column("tail"), self.length)
                made = np.zeros(len(tail), dtype=self.kind)
                for to, c in (("doc", "doc_id"), ("key", "key"), ("at", "at"), ("last", "last"), ("low", "low"), ("high", "high")):
                    made[to] = b.column(c).to_numpy()
                made["back"] = matrix(b.column("back"), self.reach)
                same = tail[1:] == tail[:-1]
                made["lcp"][1:] = np.where(same.all(axis=1), self.length, same.argmin(axis=1))
                if before is not None:
                    same = tail[0] == before
                    made["lcp"][0] = self.length if same.all() else same.argmin()
                before = tail[-1].copy()
                queue.push(0, made)
            for offset in range(self.reach + 1):
                after = self.queue()
                try:
                    yield from self.step(offset, queue, after)
                except BaseException:
                    after.close()
                    raise
                queue.close()
                queue = after
        finally:
            queue.close()

    def groups(self, block: np.ndarray, offset: int):
        """Where groups of equal windows begin in the block, and the smallest id of each."""
        active = (block["low"] <= offset) & (offset <= block["high"])
        new = block["lcp"] < self.length
        new[0] = True
        begin = np.flatnonzero(new)
        return active, begin, np.minimum.reduceat(np.where(active, block["doc"], NEVER), begin)

    def borders(self, offset: int, queue: BucketQueue) -> tuple[list[int], list[int], list[int]]:
        """Of each block the first common prefix, and the smallest ids of its first and last group over all blocks they reach."""
        lcps, firsts, lasts, members, low = [], [], [], [], NEVER

        def told():
            for where, i in members:
                where[i] = low

        for i, block in enumerate(queue.blocks(self.rows)):
            _, begin, least = self.groups(block, offset)
            lcps.append(int(block["lcp"][0]))
            firsts.append(int(least[0]))
            lasts.append(int(least[-1]))
            if i and lcps[-1] >= self.length:
                members.append((firsts, i))
                low = min(low, firsts[-1])
            else:
                told()
                members, low = [(firsts, i)], firsts[-1]
            if len(begin) > 1:
                told()
                members, low = [(lasts, i)], lasts[-1]
            else:
                members.append((lasts, i))
        told()
        return lcps, firsts, lasts

    def step(self, offset: int, queue: BucketQueue, after: BucketQueue):
        """Judges the windows whose anchor is `offset` bytes in, and induces the order of the suffixes one byte earlier."""
        lcps, firsts, lasts = self.borders(offset, queue)
        since = np.full(256, -1)  # the least common prefix since a byte's last tuple; -1: none yet
        passed = 255  # the same over tuples that left, up to the next one that stays
        for i, block in enumerate(queue.blocks(self.rows)):
            active, begin, least = self.groups(block, offset)
            least[0], least[-1] = firsts[i], lasts[i]
            hit = active & (block["doc"] > np.repeat(least, np.diff(np.append(begin, len(block)))))
            block["hits"] |= hit.astype(np.uint64) << np.uint64(offset)
            lcp = block["lcp"].astype(np.int16)
            around = np.maximum(lcp, np.append(lcp[1:], lcps[i + 1] if i + 1 < len(lcps) else 0))
            left = block["high"].astype(np.int16) - offset
            stay = (left > 0) & (around >= self.length - left)
            gone = block[~stay & (block["hits"] != 0)]
            if len(gone):
                yield from self.stretches(gone)
            kept = np.flatnonzero(stay)
            if not len(kept):
                passed = min(passed, int(lcp.min()))
                continue
            lows = np.minimum.reduceat(np.append(lcp, 255), np.concatenate([[0], kept + 1]))
            lows[0] = min(lows[0], passed)
            passed = int(lows[-1])
            self.induce(block[kept], lows[:-1], block["back"][kept, offset], since, after)

    @staticmethod
    def induce(rows: np.ndarray, lcp: np.ndarray, bytes_: np.ndarray, since: np.ndarray, after: BucketQueue) -> None:
        """Puts tuples, in order, into the queue by the byte before them; lcp: the common prefix of each with the one before."""
        order = np.argsort(bytes_, kind="stable")
        own = bytes_[order]
        begin = runs(own)
        ends = np.append(begin[1:], len(own))
        padded = np.append(lcp, 255)
        later = np.where(since >= 0, np.minimum(since, lcp.min()), since)
        for a, b in zip(begin.tolist(), ends.tolist(), strict=True):
            byte, places = int(own[a]), order[a:b]
            lows = np.minimum.reduceat(padded, np.concatenate([[0], places + 1]))
            lows[0] = min(int(lows[0]), int(since[byte])) if since[byte] >= 0 else -1
            later[byte] = lows[-1]
            part = rows[places]
            part["lcp"] = np.minimum(lows[:-1] + 1, 250)
            after.push(byte, part)
        since[:] = later

    def stretches(self, rows: np.ndarray):
        """Repeated windows as (doc, key, start, end), neighbouring ones joined."""
        m, begun = rows["hits"], np.zeros(len(rows), dtype=np.int64)
        one = np.uint64(1)
        starts, ends = m & ~(m << one), m & ~(m >> one)
        for k in range(self.reach + 1):
            bit = np.uint64(k)
            begun[(starts >> bit) & one == one] = k
            over = np.flatnonzero((ends >> bit) & one)
            if len(over):
                r = rows[over]
                yield r["doc"].copy(), r["key"].copy(), r["at"] - k, r["last"] - begun[over] + self.length


def repeated_spans(docs: DataFrame, length: int = 50, gram: int = 20, budget: int = 24 << 20, rows: int = 1 << 15) -> DataFrame:
    """doc_id, text and spans: array of (key, start, end) in bytes, repeated stretches of the rows of that id (key: the text's hash where the id has several rows of that length, else 0)."""
    if not 0 < gram <= length <= 249 or length - gram > 63:
        raise ValueError("gram is up to length, length up to 249, and length - gram up to 63: offsets are bits of a word and common prefixes bytes")
    full = docs.select("doc_id", "text").where("doc_id is not null")
    spool = cleared(docs.sparkSession, f"{shared_dir(docs.sparkSession)}/llm-{uuid.uuid4().hex}-queues")

    def find(batches):
        hasher = Hasher()
        for b in slices(batches):
            ids = b.column(0).to_numpy()
            for got in pieces(raw(b.column(1).to_pylist()), length):
                _, _, piece, h, _ = anchors(got, length, gram, hasher)
                at = runs(piece, h)
                yield pa.RecordBatch.from_arrays([pa.array(h[at].view(np.int64)), pa.array(ids[np.array([g[0] for g in got], dtype=int)[piece[at]]] if len(at) else ids[:0])], names=["h", "doc_id"])

    found = full.select("doc_id", "text").mapInArrow(find, "h long, doc_id long")
    shared = found.repartition("h").sortWithinPartitions("h", "doc_id").mapInArrow(shared_anchors, "doc_id long, h long")
    # whole copies of a document with a smaller id; an id with several rows is not taken as a copy
    whole = full.where(F.octet_length("text") >= length).select("doc_id", F.sha2("text", 256).alias("sha"), F.octet_length("text").cast("long").alias("n"))
    single = whole.groupBy("doc_id").agg(F.count("*").alias("c"), F.first("sha").alias("sha"), F.first("n").alias("n"))
    # written, so that a text with a third of all rows is one row here and its rows are split by Spark's skew join
    earliest = materialize(whole.groupBy("sha").agg(F.min("doc_id").alias("low"), F.count("*").alias("c")).where("c > 1").select("sha", "low"), "earliest")
    twice = materialize(single.where("c > 1").select("doc_id", F.lit(True).alias("twice")), "twice")
    copies = materialize(single.where("c = 1").drop("c").withColumn("key", F.lit(0).cast("long")).join(earliest, "sha").where("doc_id > low").select("doc_id", "key", "n"), "copies")
    lists = shared.join(copies.select("doc_id"), "doc_id", "left_anti").groupBy("doc_id").agg(F.collect_list("h").alias("hs"))
    lists = materialize(lists.join(twice, "doc_id", "left"), "lists")
    release(docs.sparkSession)  # the anchors' shuffle files are not needed any more
    dealt = full.repartition("doc_id")

    def snippets(batches):
        hasher, out = Hasher(), Combiner(length, gram)
        for b in slices(batches):
            ids, keys, hs = b.column("doc_id").to_numpy(), b.column("key").to_numpy(), b.column("hs")
            for got in pieces(raw(b.column("text").to_pylist()), length):
                flat, at, piece, h, pos = anchors(got, length, gram, hasher)
                doc = np.array([g[0] for g in got])[piece]
                hit = np.zeros(len(at), dtype=bool)
                edges = np.flatnonzero(np.diff(doc)) + 1
                for i, j in zip([0, *edges], [*edges, len(doc)], strict=True):
                    if i < j:
                        hit[i:j] = np.isin(h[i:j].view(np.int64), hs[int(doc[i])].values.to_numpy(zero_copy_only=False))
                at, piece, h, pos, doc = at[hit], piece[hit], h[hit], pos[hit], doc[hit]
                if not len(at):
                    continue
                begin = runs(piece, pos)  # windows of one anchor follow each other
                ends = np.append(begin[1:], len(at)) - 1
                base = np.concatenate([[0], np.cumsum([len(g[2]) for g in got])[:-1]])
                offs = np.array([g[1] for g in got])[piece[begin]] - base[piece[begin]]
                low, high = (pos[begin] - at[x] for x in (ends, begin))
                yield from out.add(flat, h[begin], ids[doc[begin]], keys[doc[begin]], pos[begin] + offs, pos[begin], low.astype(np.int16), high.astype(np.int16))
        yield from out.flush()

    around = dealt.join(lists, "doc_id").select("doc_id", "text", F.when(F.col("twice"), F.xxhash64("text")).otherwise(0).alias("key"), "hs").mapInArrow(snippets, SNIPPETS)

    def ordered(batches):
        for out in Shard(length, gram, spool, budget, rows)(batches):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["doc_id", "key", "start", "end"])

    cut = around.repartition("h").sortWithinPartitions("tail").mapInArrow(ordered, "doc_id long, key long, start long, end long")
    cut = cut.unionByName(copies.select("doc_id", "key", F.lit(0).cast("long").alias("start"), F.col("n").alias("end")))
    spans = cut.groupBy("doc_id").agg(F.collect_list(F.struct("key", "start", "end")).alias("spans"))
    return dealt.join(spans, "doc_id", "left").select("doc_id", "text", "spans").unionByName(docs.where("doc_id is null").select("doc_id", "text", F.lit(None).cast("array<struct<key:bigint,start:bigint,end:bigint>>").alias("spans")))


def union(spans: list) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


DIGESTS = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def remove_repeats(docs: DataFrame, length: int = 50, **how) -> DataFrame:
    """doc_id, kept (the remaining bytes), n_bytes and removed: the maximal removed runs."""
    found = repeated_spans(docs, length, **how).select("doc_id", "text", F.xxhash64("text").alias("key"), "spans")

    def kept(batches):
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for b in slices(batches):
            texts, keys = raw(b.column("text").to_pylist()), b.column("key").to_pylist()
            gone = [union([(s["start"], s["end"]) for s in (x or ()) if s["key"] == k or not s["key"] and len(t) >= length]) for x, k, t in zip(b.column("spans").to_pylist(), keys, texts, strict=True)]
            left = [b"".join(t[x:y] for x, y in zip([0, *(e for _, e in g)], [*(s for s, _ in g), len(t)], strict=True)) for t, g in zip(texts, gone, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(left, pa.binary()), pa.array([len(t) for t in texts], pa.int64()), pa.array([[{"start": s, "end": e} for s, e in g] for g in gone], kind)], names=["doc_id", "kept", "n_bytes", "removed"])

    return found.mapInArrow(kept, "doc_id long, kept binary, n_bytes long, removed array<struct<start:bigint,end:bigint>>")


def _digests(batches):
    for b in batches:
        gone = b.column("removed").to_pylist()
        yield pa.RecordBatch.from_arrays([
            b.column("doc_id"), b.column("n_bytes"), pa.array([sum(s["end"] - s["start"] for s in g) for g in gone], pa.int64()), pa.array([len(g) for g in gone], pa.int64()),
            pa.array([hashlib.sha256(x).hexdigest() for x in b.column("kept").to_pylist()], pa.string()),
        ], names=[x.rpartition(" ")[0] for x in DIGESTS.split(", ")])


def op7_sparse_suffix_order(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).mapInArrow(_digests, DIGESTS)
