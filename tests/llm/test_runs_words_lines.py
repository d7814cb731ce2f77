"""Periodic runs, spelling variants and line dedup against plain and slow computations, and odd tables."""

import collections
import hashlib
import random
import re
import zlib
from fractions import Fraction

import duckdb
import numpy as np
import pytest

from lotmetrics.llm import op11_runs, op12_variants, op13_lines

DIR = "/root/testdata/sf0.001"
ODD = [(1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "\n\n"), (5, "Zzz" * 30_000), (6, "la " * 4000), (6, "la " * 4000), (None, "la la"), (7, "É À ÿ×÷   x"), (8, "Ünïcödé "), (9, "퟿ end")]


def documents(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


# runs


def plain_runs(w, least, times):
    """Every period is tried at every place."""
    found, n = {}, len(w)
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(least, times * q) and j > i:
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def test_overlap():
    for least in range(2, 40):
        for times in range(2, min(least, 6) + 1):
            assert op11_runs.overlap(least, times) == min(max(least, times * q) - q for q in range(1, 100))


def test_runs_of_random_words():
    rng = random.Random(11)
    seen = 0
    for _ in range(250):
        docs = []
        for _ in range(4):
            w = []
            for _ in range(rng.randint(0, 6)):
                p = [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(rng.randint(1, 30))] * rng.choice([1, 1, 4])
                w += (p * rng.randint(1, 12))[: rng.randint(1, 150)]
            docs.append(w)
        least, times = rng.choice([(24, 3), (24, 3), (6, 2), (10, 3), (4, 4)])
        for d, got in zip(docs, op11_runs.runs_of(docs, least, times), strict=True):
            assert got == plain_runs(d, least, times)
            seen += len(got)
    assert seen > 1000


def test_runs_over_pieces(monkeypatch):
    """Pairs in many small pieces, and a run that all depths of the division meet."""
    monkeypatch.setattr(op11_runs, "PAIRS", 7)
    w = list(range(40)) * 4 + [0] * 50 + [1, 2] * 30
    assert op11_runs.runs_of([w]) == [plain_runs(w, 24, 3)]


def expected_runs(i, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(w), zlib.crc32(str(i).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a, m = g % n, 3 + g % 8
        p = 1 + (n - a) // m
        w = [w[j] if j < a else w[a + (j - a) % p] for j in range(n)]
    runs = plain_runs(w, 24, 3)
    best = max(runs, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2]), default=(None,) * 3)
    gone = {j for s, length, q in runs for j in range(s + q, s + length)}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (i, len(runs), *best, best[0] is not None and 1000 * best[1] // best[2] or None, sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), sha(" ".join(x for j, x in enumerate(w) if j not in gone)))


def test_run_query(spark):
    got = {r["doc_id"]: tuple(r) for r in op11_runs.op11_periodic_runs(spark, DIR).collect()}
    docs = documents(spark)
    assert len(got) == len(docs)
    checked = [(i, t) for i, t in docs if len((t or "").split()) < 2500]
    assert all(got[i] == expected_runs(i, t) for i, t in checked) and sum(got[i][1] > 0 for i, _ in checked) > 5


def test_runs_of_odd_tables(spark):
    rows = op11_runs.periodic_runs(frame(spark, ODD), block=50).collect()
    assert len(rows) == len(ODD)
    by = collections.defaultdict(list)
    for r in rows:
        by[r["doc_id"]].append(r)
    assert all(by[i][0]["n_runs"] == 0 and by[i][0]["collapsed"] == b"" and by[i][0]["start"] is None for i in (1, 2, 3, 4))
    assert [(r["n_runs"], r["length"], r["collapsed"].decode()) for r in by[6]] == [(1, 4000, "la")] * 2
    assert by[None][0]["collapsed"] == b"la la"
    assert op11_runs.periodic_runs(frame(spark, [])).count() == 0
    clash = frame(spark, ODD[:2]).selectExpr("*", "1 as runs", "2 as _text")
    assert op11_runs.periodic_runs(clash, keep=("doc_id", "_text")).count() == 2
    with pytest.raises(ValueError, match="differ"):
        op11_runs.periodic_runs(clash, keep=("doc_id", "runs"))


# words


def near(a, b):
    """One insertion, deletion or replacement."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain_groups(words, factor=10):
    out = set()
    form = {}
    for w, n in words.items():
        by = [x for x in words if near(w, x)]
        best = min(by, key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= factor * n:
            form[w] = best
        out.add((w, n, len(by)))

    def root(w):
        return root(form[w]) if w in form else w

    return {(w, form.get(w), root(w), n, k, words[form[w]] if w in form else None) for w, n, k in out}


def as_set(df):
    return {tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in df.collect()}


def test_groups_of_random_words(spark):
    """Small alphabets, so that words have repeated bigrams and many neighbours; accents, so that bytes are not code points."""
    rng = random.Random(12)
    for alphabet, size in (("ab", 8), ("abcé", 7), ("abcdefghijÿ", 4)):
        words = {}
        while len(words) < 250:
            w = "".join(rng.choice(alphabet) for _ in range(rng.randint(max(4, size - 2), size + 4)))
            for _ in range(rng.randint(0, 2)):
                k = rng.randrange(len(w))
                w = rng.choice([w[:k] + w[k + 1 :], w[:k] + rng.choice(alphabet) + w[k:], w[:k] + rng.choice(alphabet) + w[k + 1 :]])
            if len(w) >= 4:
                words[w] = 10 ** rng.randint(0, 5) + rng.randint(0, 3)
        assert as_set(op12_variants.spelling_groups(spark.createDataFrame(list(words.items()), "word string, n long"))) == plain_groups(words)


def test_chains_of_forms(spark):
    words = {"abcdefg": 1, "abcdefgh": 20, "abcdefghi": 400, "abcdefghij": 9000, "abcdefghik": 9000, "zzzzzzz": 5}
    got = as_set(op12_variants.spelling_groups(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert got == plain_groups(words)
    assert ("abcdefg", "abcdefgh", "abcdefghij", 1, 1, 20) in got and ("abcdefghij", None, "abcdefghij", 9000, 2, None) in got


def test_word_query(spark):
    count = collections.Counter()
    for i, t in documents(spark):
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{i}:{w}".encode())
            count[w if h % 31 else w[: h % len(w)] + w[h % len(w) + 1 :]] += 1
    words = {w: n for w, n in count.items() if len(w) >= 7 and n >= 2}
    masks = collections.defaultdict(set)
    for w in words:
        for k in range(len(w)):
            masks[w[:k], w[k + 1 :]].add(w)
            masks[w[:k], w[k:]].add(w)
        masks[w, ""].add(w)
    close = collections.defaultdict(set)
    for group in masks.values():
        for a in group:
            close[a] |= {b for b in group if near(a, b)}
    got = as_set(op12_variants.op12_spelling_variants(spark, DIR))
    assert {(w, n, k) for w, _, _, n, k, _ in got} == {(w, n, len(close[w])) for w, n in words.items()}
    for w, form, root, n, _, form_n in got:
        best = min(close[w], key=lambda x: (-words[x], x), default=None)
        assert (form, form_n) == ((best, words[best]) if best is not None and words[best] >= 10 * n else (None, None))
        assert (root == w) == (form is None)


def test_words_of_odd_tables(spark):
    counts = {r["word"]: r["n"] for r in op12_variants.word_counts(frame(spark, ODD), 2, 1).collect()}
    assert counts["la"] == 8002 and counts["ünïcödé".replace("ü", "Ü")] == 1 and counts["zzz" * 30_000] == 1 and "x" not in counts
    assert counts["ÿ×÷"] == 1
    empty = op12_variants.spelling_groups(op12_variants.word_counts(frame(spark, [])))
    assert empty.count() == 0
    named = frame(spark, ODD).selectExpr("*", "1 as word", "2 as n", "3 as _id")
    assert op12_variants.word_counts(named).count() == op12_variants.word_counts(frame(spark, ODD)).count()
    with pytest.raises(ValueError, match="factor"):
        op12_variants.spelling_groups(spark.createDataFrame([("abcd", 1)], "word string, n long"), 1)


# lines


def plain_lines(docs, at_least):
    keys = [[x.strip(" \t\n\x0b\x0c\r") for x in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "").split("\n")] for t in docs]
    held = collections.Counter(k for ks in keys for k in set(ks) if k)
    out = []
    for t, ks in zip(docs, keys, strict=True):
        kept = [x for x, k in zip((t or "").split("\n"), ks, strict=True) if not k or held[k] < at_least]
        out.append((len(ks), len(ks) - len(kept), "\n".join(kept)))
    return out, held


def test_perfect_hash():
    rng = np.random.default_rng(13)
    for n in (0, 1, 2, 1000, 70_000):
        low, high, counts = rng.integers(0, 1 << 63, n, dtype=np.uint64), rng.integers(0, 1 << 63, n, dtype=np.uint64), rng.integers(1, 300, n)
        if n > 10:
            low[: n // 2] = low[0]  # half of the hash alone tells nothing
        shard = op13_lines.Shard.of(low, high, counts)
        assert sorted(shard.hashed.number(low, high).tolist()) == list(range(n))
        assert (shard.count(low, high) == counts).all()
        other = rng.integers(0, 1 << 63, 5000, dtype=np.uint64)
        assert not shard.count(other, other).any()
        if n > 1000:
            assert len(shard.hashed.words) * 64 / n < 4 and shard.counts.dtype.itemsize == 2
    with pytest.raises(ValueError, match="distinct"):
        op13_lines.PerfectHash.of(np.array([1, 1], dtype=np.uint64), np.array([2, 2], dtype=np.uint64))


@pytest.mark.parametrize("shards", [1, 9])
def test_lines_by_hand(spark, shards):
    docs = [*documents(spark), (-1, None), (-2, ""), (-3, "\n"), (-4, "A\n a \nA\nb"), (-5, "a\t"), (-6, "a"), (-6, "a")]
    want, held = plain_lines([t for _, t in docs], 3)
    df = frame(spark, docs)
    every = op13_lines.index_lines(df, keys=max(1, len(held) // shards))
    assert every.keys == len(held) and every.shards >= shards
    frequent = op13_lines.index_lines(df, least=3)
    assert frequent.keys == sum(n >= 3 for n in held.values())
    for index, cache in ((every, 1), (every, 1 << 20), (frequent, 1 << 20)):
        got = op13_lines.drop_lines(df, index, 3, block=1000, cache=cache).collect()
        assert sorted((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept"]) for r in got) == sorted((i, *w) for (i, _), w in zip(docs, want, strict=True))
    with pytest.raises(ValueError, match="min_docs"):
        op13_lines.drop_lines(df, frequent, 2)


def test_line_query_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{DIR}/documents.parquet'")
    want = con.execute(op13_lines.SQL).df()
    got = op13_lines.op13_common_lines(spark, DIR).toPandas()[list(want.columns)]
    assert sorted(map(tuple, got.to_numpy().tolist())) == sorted(map(tuple, want.to_numpy().tolist())) and want["n_dropped"].sum() > 0


def test_lines_of_odd_tables(spark):
    df = frame(spark, ODD)
    got = op13_lines.drop_lines(df, op13_lines.index_lines(df), 2).collect()
    assert len(got) == len(ODD) and {r["n_dropped"] for r in got if r["doc_id"] == 6} == {1}
    assert {r["kept"] for r in got if r["doc_id"] in (1, 2)} == {""}
    long = op13_lines.index_lines(df, min_chars=8)
    assert op13_lines.drop_lines(df, long, 1).where("n_dropped > 0 and doc_id = 8").count() == 0  # seven code points, more bytes
    empty = frame(spark, [])
    assert op13_lines.drop_lines(empty, op13_lines.index_lines(empty), 1).count() == 0
    assert op13_lines.drop_lines(df, op13_lines.index_lines(empty), 1).where("n_dropped > 0").count() == 0
    clash = df.selectExpr("*", "1 as kept", "2 as _text")
    assert op13_lines.drop_lines(clash, op13_lines.index_lines(clash), 1, keep=("doc_id", "_text")).count() == len(ODD)
    with pytest.raises(ValueError, match="differ"):
        op13_lines.drop_lines(clash, long, 1, keep=("doc_id", "kept"))
