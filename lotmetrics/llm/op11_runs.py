"""Periodic runs of words: found exactly, then collapsed to their first period.

A run is a stretch of consecutive words whose smallest period q (words q apart are
identical) fits it `times` times at least, of at least `least` words, that no
neighbouring word extends keeping period q.

1. A run and its shift by q overlap in at least k words, whatever q: k follows
   from `least` and `times` (overlap()).  So every word of a run lies in a k-gram
   that its document has twice.  All other words are masked; they cannot join runs.
2. On the surviving segments alone, Main and Lorentz's division: a segment is
   halved, the runs across its middle are found, then those inside either half.  For
   a period q, a run across the middle m has half of its overlap directly before or
   after m, compared with its shift by q or -q.  These comparisons are made for all
   q of all segments of a depth at once, by prefix sums of hashed words.  What
   agrees is extended word by word, exactly, so a chance agreement of hashes costs
   time and changes nothing.
3. Periods are tried from the smallest; multiples of a period within its run are
   that run again and are skipped.

Null and empty texts have no words and no runs.  Documents are independent:
repeated rows have equal results, an empty table gives none, null ids are kept.
Memory grows with the longest text (about 100 bytes a word), as a run can be all of
it.  Columns in `keep` may have any name but those that the operator returns, which
raises ValueError.
"""

import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, table, text_and
from .op7_repeats import ODD, mixed, powers

#: Pairs of a middle and a period that are compared at once.
PAIRS = 1 << 20
NOTHING = np.zeros(0, dtype=np.int64)


def overlap(least: int, times: int) -> int:
    """The fewest words in which a run and its shift by its period overlap."""
    q = least // times
    return min(least - q, (times - 1) * (q + 1)) if q else (times - 1)


class Words:
    """Word numbers of several documents on end, with prefix sums of their hashes."""

    def __init__(self, ids: np.ndarray):
        self.ids = ids
        self.up = powers(ODD, len(ids) + 1)
        self.sums = np.zeros(len(ids) + 1, dtype=np.uint64)
        np.cumsum(mixed(ids.astype(np.uint64) + np.uint64(1)) * self.up[:-1], out=self.sums[1:])

    def same(self, at: np.ndarray, q: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether n words from `at` on and from at + q on have equal hashes."""
        return (self.sums[at + n] - self.sums[at]) * self.up[q] == self.sums[at + q + n] - self.sums[at + q]

    def grams(self, at: np.ndarray, k: int) -> np.ndarray:
        """Hashes of the k-grams at `at`, equal for equal ones."""
        return mixed((self.sums[at + k] - self.sums[at]) * self.up[len(self.ids) - at])

    def ahead(self, at: int, q: int, end: int) -> int:
        """How many words from `at` on agree with those q later; the later ones end at `end`."""
        done, step, last = 0, 64, end - q - at
        while done < last:
            a = at + done
            n = min(step, last - done)
            differ = self.ids[a : a + n] != self.ids[a + q : a + q + n]
            if differ.any():
                return done + int(differ.argmax())
            done, step = done + n, step * 2
        return max(last, 0)

    def back(self, at: int, q: int, begin: int) -> int:
        """How many words before `at`, down to `begin`, agree with those q later."""
        done, step = 0, 64
        while at - done > begin:
            b = at - done
            n = min(step, b - begin)
            differ = (self.ids[b - n : b] != self.ids[b - n + q : b + q])[::-1]
            if differ.any():
                return done + int(differ.argmax())
            done, step = done + n, step * 2
        return at - begin


def segments(words: Words, ends: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of every maximal stretch of words that repeated k-grams of their document cover."""
    n = len(words.ids)
    begins = np.concatenate([[0], ends[:-1]])
    doc = np.repeat(np.arange(len(ends)), ends - begins)
    at = np.flatnonzero(np.arange(n) + k <= ends[doc]) if n else NOTHING
    grams = words.grams(at, k) ^ mixed(doc[at].astype(np.uint64) + np.uint64(7))
    ordered = np.sort(grams)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return NOTHING, NOTHING
    place = np.minimum(np.searchsorted(twice, grams), len(twice) - 1)
    at = at[twice[place] == grams]
    step = np.zeros(n + 1, dtype=np.int64)
    np.add.at(step, at, 1)
    np.add.at(step, at + k, -1)
    covered = np.cumsum(step[:-1]) > 0
    opens = covered & np.concatenate([[True], ~covered[:-1]])
    opens[begins[(begins < n)]] |= covered[begins[(begins < n)]]
    low = np.flatnonzero(opens)
    shut = np.concatenate([~covered[1:] | opens[1:], [True]]) & covered
    return low, np.flatnonzero(shut) + 1


def agreeing(words: Words, low: np.ndarray, high: np.ndarray, least: int, times: int):
    """Middle, period, first word and number of words (period included) of every agreement at the middle of a range."""
    mid, most = (low + high) // 2, (high - low) // times
    total = np.cumsum(most)
    for first in range(0, int(total[-1]) if len(total) else 0, PAIRS):
        flat = np.arange(first, min(first + PAIRS, int(total[-1])))
        own = np.searchsorted(total, flat, side="right")
        q = flat - (total - most)[own] + 1
        m, a, b = mid[own], low[own], high[own]
        c = -(-np.maximum(least - q, (times - 1) * q) // 2)
        for at in (m, m - c, m - q, m - q - c):
            fits = np.flatnonzero((at >= a) & (at + q + c <= b))
            fits = fits[words.same(at[fits], q[fits], c[fits])]
            if len(fits):
                yield m[fits], q[fits], at[fits], (q + c)[fits]


def find(words: Words, low: np.ndarray, high: np.ndarray, least: int, times: int) -> list[tuple[int, int, int]]:
    """(begin, end, period) of all runs inside the segments, in order."""
    found: dict[tuple[int, int], int] = {}
    tops, bottoms = low, high
    while True:
        long = high - low >= least
        low, high = low[long], high[long]
        if not len(low):
            return sorted((b, e, q) for (b, e), q in found.items())
        got = list(agreeing(words, low, high, least, times))
        if got:
            m, q, at, n = (np.concatenate(x) for x in zip(*got, strict=True))
            order = np.lexsort((q, m))
            m, q, at, n = m[order], q[order], at[order], n[order]
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(m)) + 1, [len(m)]])
            known = sorted((b, e, p) for (b, e), p in found.items())
            near, reached = [], 0
            for x, y in zip(cuts[:-1], cuts[1:], strict=True):
                middle = int(m[x])
                while reached < len(known) and known[reached][0] <= middle:
                    near.append(known[reached])
                    reached += 1
                near = [r for r in near if r[1] >= middle]
                left = np.arange(x, y)
                for b, e, p in near:
                    left = left[(q[left] % p != 0) | (at[left] < b) | (at[left] + n[left] > e)]
                if len(left):
                    s = int(np.searchsorted(tops, middle, side="right")) - 1
                while len(left):
                    i = left[0]
                    p, a = int(q[i]), int(at[i])
                    b = a - words.back(a, p, int(tops[s]))
                    e = a + p + words.ahead(a, p, int(bottoms[s]))
                    left = left[1:]
                    if e - b >= max(least, times * p):
                        found[b, e] = min(p, found.get((b, e), p))
                        near.append((b, e, p))
                        left = left[(q[left] % p != 0) | (at[left] < b) | (at[left] + n[left] > e)]
        mid = (low + high) // 2
        low, high = np.concatenate([low, mid]), np.concatenate([mid, high])


def runs_of(documents: list[list], least: int = 24, times: int = 3) -> list[list[tuple[int, int, int]]]:
    """For each list of words (anything that can be a key): (start, length, period) of its runs, by start, then period."""
    numbers: dict = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for d in documents for w in d], dtype=np.int64)
    ends = np.cumsum([len(d) for d in documents])
    out = [[] for _ in documents]
    if len(ids):
        words = Words(ids)
        for b, e, q in find(words, *segments(words, ends, overlap(least, times)), least, times):
            d = int(np.searchsorted(ends, b, side="right"))
            out[d].append((b - int(ends[d]) + len(documents[d]), e - b, q))
    return [sorted(x, key=lambda r: (r[0], r[2])) for x in out]


def kept_words(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run contains after its first period."""
    if not runs:
        return words
    step = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        step[start + period] += 1
        step[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(step[:-1]) == 0)]


def split(text: bytes | None, _row: dict) -> list[bytes]:
    return (text or b"").split()


RESULT = "n_runs long, start long, length long, period long, exponent_milli long, runs array<struct<start:long,length:long,period:long>>, collapsed binary"


def periodic_runs(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), least: int = 24, times: int = 3, words=split, block: int = 4 << 20) -> DataFrame:
    """The columns keep, n_runs, the run of the greatest exact exponent (start, length, period, exponent_milli; null without
    runs; ties: smallest start, then period), all runs and the collapsed text, words joined by one space.

    words(text bytes or None, {kept column: value}) gives a document's words.
    """
    names = [x.split()[0] for x in RESULT.replace("struct<start:long,length:long,period:long>", "x").split(", ")]
    if times < 2 or least < times or {c.lower() for c in keep} & set(names):
        raise ValueError("times is at least 2, least at least times, and kept columns differ from those returned")
    rows = text_and(docs, text, keep)
    shape = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def search(batches):
        for b in blocks(batches, block):
            kept = b.drop_columns([b.schema.names[0]])
            texts = [words(t, row) for t, row in zip(b.column(0).to_pylist(), kept.to_pylist() if words is not split else [{}] * b.num_rows, strict=True)]
            every = runs_of(texts, least, times)
            best = [max(r, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2]), default=None) for r in every]
            one = [pa.array([r and r[i] for r in best], pa.int64()) for i in range(3)]
            milli = pa.array([r and 1000 * r[1] // r[2] for r in best], pa.int64())
            lists = pa.array([[dict(zip(("start", "length", "period"), x, strict=True)) for x in r] for r in every], pa.list_(shape))
            collapsed = pa.array([b" ".join(kept_words(t, r)) for t, r in zip(texts, every, strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array([len(r) for r in every], pa.int64()), *one, milli, lists, collapsed], names=[*kept.schema.names, *names])

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[1:])
    return rows.mapInArrow(search, fields + RESULT)


def planted(text: bytes | None, row: dict) -> list[bytes]:
    """The words, of which every tenth document repeats some from one of them on."""
    found = (text or b"").split()
    h, n = zlib.crc32(str(row["doc_id"]).encode()), len(found)
    if h % 10 or not n:
        return found
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [found[i if i < a else a + (i - a) % p] for i in range(n)]


def op11_periodic_runs(spark, sf_dir: str) -> DataFrame:
    runs = periodic_runs(table(spark, sf_dir, "documents"), words=planted)
    line = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return runs.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
