"""The corpus operators against brute force, on small tables with odd rows."""

import hashlib
import itertools
import os
import random
import re
import tracemalloc

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute
import pytest
from pyspark.sql import functions as F

from lotmetrics.llm import op1_url_filter, op2_packing, op3_language, op4_chat, op5_pii, op6_simhash, op7_repeats, op8_quality, op9_media, op10_decontaminate, registry

DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TEXTS = [None, "", " ", "a", "The quick brown fox jumps over the lazy dog and runs away from it", "the quick brown fox jumps over the lazy dog and runs away from it again", "x" * 30_000, "é" * 70 + " ok", "é" * 70 + " ok"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, None, None, None, 0.5) for i, t in enumerate(TEXTS)] + [(None, TEXTS[4], "en", "s", 1, None), (4, TEXTS[4], "en", "s", 1, None)], SCHEMA).cache()


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(DIR):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{DIR}/{f}'")
    want = con.execute(registry.ORACLE[name]).df()
    columns = sorted(want.columns)
    rows = lambda df: sorted(map(repr, df[columns].itertuples(index=False, name=None)))
    assert rows(registry.QUERIES[name](spark, DIR).toPandas()) == rows(want)


def test_urls_of_odd_rows(spark):
    urls = [None, "", "nothing", "HTTP://A.Example.COM/en/x?y", "x://net/es/", "x://b.net", "a://b://c/d#e"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    empty = spark.createDataFrame([], "page_id long, good int")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in op1_url_filter.filter_urls(pages, empty).collect()}
    assert got[0][:3] == got[1][:3] == got[2][:3] == ("", "", None)
    assert got[3] == ("a.example.com", "/en/x", "example.com/en/", "block")
    assert got[4] == ("net", "/es/", "net/es/", "block") and got[5][:3] == ("b.net", "", None) and got[6][:2] == ("b:", "//c/d")
    bad = spark.createDataFrame([(5, 0)] * 40, "page_id long, good int")
    assert {r["page_id"]: r["verdict"] for r in op1_url_filter.filter_urls(pages, bad, rules=()).collect()}[5] == "block"
    assert op1_url_filter.filter_urls(pages.limit(0), empty).count() == 0


def test_very_long_rows_and_clashing_columns(spark):
    """A url, a conversation's turn and a text of a million characters, in tables whose other columns have the operators' own names."""
    pages = spark.createDataFrame([(1, "http://a.example.com/en/" + "x" * 1_000_000, "h", "p", 0.5)], "page_id long, url string, host string, path string, verdict double")
    labels = spark.createDataFrame([(1, 1, "x")], "page_id long, good int, host string")
    got = op1_url_filter.filter_urls(pages, labels).select("page_id", "host", F.length("path").alias("n"), "rule").collect()
    assert [tuple(r) for r in got] == [(1, "a.example.com", 1_000_004, "example.com/en/")]
    long = "</turn>" + "### a: b\n" * 100_000
    turns = spark.createDataFrame([(1, 0, "user", long, "x"), (1, 1, "assistant", long, "y")], "conv_id long, turn int, role string, text string, segment string")
    back = op4_chat.read_back(op4_chat.format_turns(turns)).first()
    assert back["n_turns"] == 2 and back["loss_chars"] == len(long) and back["loss_sha256"] == hashlib.sha256(long.encode()).hexdigest()
    words = " ".join(f"w{k}" for k in range(150_000))
    docs = spark.createDataFrame([(1, words, 1, 2, 3), (2, words + " end", 4, 5, 6)], "doc_id long, text string, fp int, node int, bucket int")
    prints = {r["doc_id"]: r["fp"] for r in op6_simhash.fingerprints(docs).collect()}
    assert bin((prints[1] ^ prints[2]) & ((1 << 64) - 1)).count("1") <= 4
    assert {r["component_id"] for r in op6_simhash.near_components(op6_simhash.fingerprints(docs)).collect()} == {1}
    assert {r["n_tokens"] for r in op2_packing.pack(docs).collect()} == {150_000, 150_001}
    for make, names in ((lambda d, keep: op3_language.predict(d, None, keep=keep), ("lang_pred", "score")), (lambda d, keep: op5_pii.find_pii(d, keep=keep), ("pii",)), (lambda d, keep: op9_media.media_columns(d, keep=keep), ("media", "n_bytes", "fingerprint"))):
        for name in names:
            with pytest.raises(ValueError, match=name):
                make(docs.withColumnRenamed("fp", name), ("doc_id", name))
        assert make(docs.limit(1).selectExpr("doc_id", "'a b' text", "7 as _text"), ("doc_id", "_text")).first()["_text"] == 7


def test_boundaries_are_optimal():
    rng = random.Random(1)
    for _ in range(40):
        n, k = rng.randint(1, 8), rng.randint(1, 4)
        lengths, counts = sorted(rng.sample(range(50), n)), [rng.randint(1, 9) for _ in range(n)]
        cost = lambda ends: sum(c * min(e for e in ends if e >= x) for x, c in zip(lengths, counts))  # noqa: B023,B905,E731
        best = min(cost([*c, lengths[-1]]) for r in range(k) for c in itertools.combinations(lengths[:-1], r))
        ends = op2_packing.boundaries(lengths, counts, k)
        assert len(ends) <= k and cost(ends) == best


def test_packing_keeps_all_rows_within_budget(spark, odd):
    got = op2_packing.pack(odd, buckets=3, budget=16, rows_a_shard=2).collect()
    assert len(got) == len(TEXTS) + 2
    batches: dict = {}
    for r in got:
        batches.setdefault((r["bucket"], r["batch"]), []).append(r["bucket_len"])
    assert all(sum(v) <= 16 or len(v) == 1 for v in batches.values())
    assert op2_packing.pack(odd.limit(0)).count() == 0


def test_packing_of_long_texts_is_optimal(spark):
    lengths = [3000] * 5 + [3001] * 4 + [3003] * 3 + [9000] * 2 + [9004]
    docs = spark.createDataFrame([(i, None, n) for i, n in enumerate(lengths)], "doc_id long, text string, n long")
    cost = lambda ends: sum(min(e for e in ends if e >= n) - n for n in lengths)
    for buckets in (2, 3, 5):
        best = min(cost([*c, 9004]) for r in range(buckets) for c in itertools.combinations([3000, 3001, 3003, 9000], r))
        got = op2_packing.pack(docs, buckets=buckets, length=F.col("n")).collect()
        assert len(got) == len(lengths) and sum(r["padding"] for r in got) == best


def test_language_of_held_out_documents(spark, odd):
    got = op3_language.op3_partial_matching(spark, DIR).join(spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 0.95 * len(got)
    trees = op3_language.fit(spark.createDataFrame([(1, "abab abab", "x", None, None, None), (2, "cdcd cdcd", "y", None, None, None)], SCHEMA))
    rows = {r["doc_id"]: r["lang_pred"] for r in op3_language.predict(odd, trees).collect()}
    assert rows[0] == rows[1] == rows[2] == "und" and rows[3] in "xy"
    assert {r["lang_pred"] for r in op3_language.predict(odd, None).collect()} == {"und"}


def test_code_lengths_by_hand():
    trees = op3_language.Trees({"x": ["aab"]}, order=1)
    # contexts: "" has \n? no: counts start after the padding of ORDER bytes
    flat = np.frombuffer(b"\n" * 4 + b"aab", dtype=np.uint8)
    one = trees.cost(0, np.array([ord("a")], dtype=np.uint64))[0, 0]
    assert one > 0 and np.isfinite(trees.lengths(flat, np.array([0]))).all()
    new = trees.cost(0, np.array([ord("z")], dtype=np.uint64))[0, 0]
    assert new > 8  # an escape and the uniform byte


def test_round_trip_of_hard_turns():
    hard = ["", "\\", "\\\\", "### User: x</turn>\n### ", "</turn>", "</turn>\n", "a: b", op4_chat.HARD, "\n", "x\\"]
    for role, text in itertools.product(["user", "assistant", "User", "a: b", "", "###", "\\"], hard):
        made, _ = op4_chat.segment(role, text)
        assert op4_chat.parse(made) == [(role, text)]
        assert op4_chat.parse(made + made) == [(role, text)] * 2


def test_conversations(spark):
    rows = spark.createDataFrame([(1, 1, "assistant", "b"), (1, 0, "user", None), (None, 0, "user", "x"), (1, 1, "assistant", "b")], "conv_id long, turn int, role string, text string")
    got = {r["conv_id"]: r for r in op4_chat.read_back(op4_chat.format_turns(rows)).collect()}
    assert got[1]["n_turns"] == 3 and got[1]["loss_sha256"] == hashlib.sha256(b"bb").hexdigest()
    assert got[1]["turns_sha256"] == hashlib.sha256(b"user\n\nassistant\nb\nassistant\nb\n").hexdigest() and got[None]["loss_chars"] == 0


def test_personal_data_against_expressions():
    kinds = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def base(t):
        out = []
        for kind, p in kinds.items():
            for m in re.finditer(p, t):
                d = re.sub(r"\D", "", m[0])
                if kind == "ip" and max(map(int, m[0].split("."))) > 255 or kind == "card" and not (14 <= len(d) <= 19 and op5_pii.luhn(d)) or kind == "phone" and not 10 <= len(d) <= 15:
                    continue
                out.append((m.start(), m.end(), kind))
        return sorted(out, key=lambda x: (x[0], op5_pii.KINDS.index(x[2])))

    rng, cues = random.Random(3), op5_pii.automaton()
    for _ in range(4000):
        t = "".join(rng.choice(["1", "22", "255", "4111111111111111", ".", "@", "a", "-", " ", "+", "(", "é", "b.c", "1.2.3.4"]) for _ in range(rng.randint(0, 14)))
        assert [x for x in op5_pii.spans(t, cues) if x[2] in op5_pii.BASE] == base(t), t
    assert op5_pii.redact("mail a@b.cd or https://u:p@h.org/ IBAN: GB82 WEST 1234 5698 7654 32.", cues) == "mail [EMAIL] or [URL]/ IBAN: [ACCOUNT]."


def test_components_against_all_pairs(spark):
    rng = random.Random(5)
    centre = rng.getrandbits(64)
    prints = [centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for _ in range(150)] + [rng.getrandbits(64) for _ in range(100)] + [0, 0, 7]
    for bits in (2, 4, 6):
        parent = list(range(len(prints)))

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for i, j in itertools.combinations(range(len(prints)), 2):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
        rows = spark.createDataFrame([(i, op6_simhash.signed(p)) for i, p in enumerate(prints)], "doc_id long, fp long")
        got = {r["doc_id"]: r["component_id"] for r in op6_simhash.near_components(rows, bits).collect()}
        assert got == {i: find(i) for i in range(len(prints))}


def test_crowd_of_near_copies_against_all_pairs(spark):
    rng = random.Random(11)
    base = [f"w{rng.randint(0, 999)}" for _ in range(120)]
    texts = []
    for k in range(170):
        words = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 3, 5, 8])):
            words[rng.randrange(len(words))] = f"x{rng.randint(0, 999)}"
        texts.append(" ".join(words[: rng.choice([120, 120, 115, 100])]))
    texts += [" ".join(f"u{rng.randint(0, 99)}" for _ in range(rng.randint(0, 60))) for _ in range(60)] + ["same line " * 40 + "a b c d e f", "same line " * 40 + "g h i j k l"]
    hashes = [op6_simhash.shingle_hashes(t, 5) for t in texts]
    prints, sets = [op6_simhash.fingerprint(h) for h in hashes], [set(h.tolist()) for h in hashes]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(texts)), 2):
        if texts[i] == texts[j] or (prints[i] ^ prints[j]).bit_count() <= 10 and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9:
            a, b = sorted((find(i), find(j)))
            parent[b] = a
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"] for r in op6_simhash.drop_near_copies(docs).select("doc_id").collect()}
    assert got == {find(i) for i in range(len(texts))}


def test_near_copies_with_far_fingerprints(spark):
    rng = random.Random(23)
    texts = []
    for k in range(120):
        words = [f"w{rng.randint(0, 999)}" for _ in range(rng.choice([6, 12, 30, 60, 200]))]
        texts += [" ".join(words), " ".join(words[: len(words) * 4 // 5 + rng.randint(0, 3)]), " ".join([*words, *(f"y{rng.randint(0, 999)}" for _ in range(len(words) // rng.choice([5, 6, 8])))])]
        texts.append(" ".join([*(f"z{rng.randint(0, 999)}" for _ in range(30)), "a very common line that stands in many of the texts"]))
    rng.shuffle(texts)
    hashes = [op6_simhash.shingle_hashes(t, 5) for t in texts]
    prints, sets = [op6_simhash.fingerprint(h) for h in hashes], [set(h.tolist()) for h in hashes]
    parent, far = list(range(len(texts))), 0

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(texts)), 2):
        if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9:
            far += (prints[i] ^ prints[j]).bit_count() > 10
            a, b = sorted((find(i), find(j)))
            parent[b] = a
    assert far > 5
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"] for r in op6_simhash.drop_near_copies(docs).select("doc_id").collect()}
    assert got == {find(i) for i in range(len(texts))}


def test_near_copies_and_odd_rows(spark, odd):
    got = {r["doc_id"] for r in op6_simhash.drop_near_copies(odd).select("doc_id").collect()}
    assert {3, 4, 6, 7} <= got and 8 not in got
    assert op6_simhash.near_components(op6_simhash.fingerprints(odd.limit(0))).count() == 0


@pytest.mark.parametrize("how", [{"budget": 2000, "rows": 7}, {}])
def test_repeats_against_brute_force(spark, odd, how):
    rng = random.Random(7)
    parts = ["".join(rng.choice("abcde ") for _ in range(rng.choice([20, 45, 49, 50, 51, 120]))) for _ in range(12)]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 6)))) for i in range(60)]
    docs = spark.createDataFrame(rows + [(61, rows[5][1]), (None, rows[5][1])], "doc_id long, text string")
    first: dict = {}
    for i, t in [*rows, (61, rows[5][1])]:
        for k in range(len(t) - 49):
            first.setdefault(t[k : k + 50], i)
    for r in op7_repeats.remove_repeats(docs, **how).collect():
        t = rows[5][1] if r["doc_id"] in (61, None) else rows[r["doc_id"]][1]
        gone = [False] * len(t)
        for k in range(len(t) - 49):
            if r["doc_id"] is not None and first[t[k : k + 50]] < r["doc_id"]:
                gone[k : k + 50] = [True] * 50
        assert bytes(r["kept"]).decode() == "".join(c for c, g in zip(t, gone, strict=True) if not g)
    assert op7_repeats.remove_repeats(odd).count() == len(TEXTS) + 2


def covered(texts: list[tuple[int, bytes]], **how) -> dict:
    """The repeated stretches by the shard alone, all windows of each text around their own anchors."""
    rows, hasher, spool = [], op7_repeats.Hasher(), op7_repeats.Combiner(50, 20)
    for doc, t in texts:
        for got in op7_repeats.pieces([t], 50):
            flat, at, piece, h, pos = op7_repeats.anchors(got, 50, 20, hasher)
            begin = op7_repeats.runs(piece, pos)
            ends = np.append(begin[1:], len(at)) - 1
            offs = np.array([g[1] for g in got])[piece[begin]] - np.concatenate([[0], np.cumsum([len(g[2]) for g in got])[:-1]])[piece[begin]]
            ids = np.full(len(begin), doc)
            low, high = ((pos[begin] - at[x]).astype(np.int16) for x in (ends, begin))
            rows += spool.add(flat, h[begin], ids, 0 * ids, pos[begin] + offs, pos[begin], low, high)
    table = pa.Table.from_batches([*rows, *spool.flush()])
    batches = table.take(pa.compute.sort_indices(table, [("tail", "ascending")], null_placement="at_start")).to_batches(max_chunksize=97)
    out: dict = {}
    for part in op7_repeats.Shard(50, 20, **how)(iter(pa.RecordBatch.from_arrays([c.cast(c.type) for c in b.columns], schema=b.schema) for b in batches)):
        for doc, _, a, b in zip(*(x.tolist() for x in part), strict=True):
            out.setdefault(doc, []).append((a, b))
    return {d: op7_repeats.union(v) for d, v in out.items()}


def repeated(texts: list[tuple[int, bytes]]) -> dict:
    first: dict = {}
    for i, t in texts:
        for k in range(len(t) - 49):
            first[t[k : k + 50]] = min(i, first.get(t[k : k + 50], i))
    out: dict = {}
    for i, t in texts:
        spans = [(k, k + 50) for k in range(len(t) - 49) if first[t[k : k + 50]] < i]
        if spans:
            out[i] = op7_repeats.union(spans)
    return out


@pytest.mark.parametrize("letters", ["ab", "a", "abcdefgh "])
def test_induced_order_on_disk_against_brute_force(tmp_path, letters):
    rng = random.Random(13)
    common = "".join(rng.choices(letters, k=70))
    texts = []
    for i in rng.sample(range(400), 70):
        t = "".join(rng.choices(letters, k=rng.randint(0, 90))) + common[rng.randint(0, 20) : rng.randint(40, 70)] + "".join(rng.choices(letters, k=rng.randint(0, 90)))
        texts.append((i, t.encode()))
    want = repeated(texts)
    for budget, rows in ((1 << 30, 1 << 15), (3000, 1 << 15), (3000, 5), (1 << 30, 1)):
        assert covered(texts, spool=f"file://{tmp_path}/queues", budget=budget, rows=rows) == want
    assert not list(tmp_path.glob("queues/*"))  # files of the queues are deleted


def test_periodic_text_is_one_row():
    t = b"abcdefg" * 20_000
    out = op7_repeats.Combiner(50, 20)
    flat, at, piece, h, pos = op7_repeats.anchors([(0, 0, t)], 50, 20, op7_repeats.Hasher())
    begin = op7_repeats.runs(piece, pos)
    low, high = ((pos[begin] - at[x]).astype(np.int16) for x in (np.append(begin[1:], len(at)) - 1, begin))
    ids = np.zeros(len(begin), dtype=np.int64)
    assert sum(b.num_rows for b in [*out.add(flat, h[begin], ids, ids, pos[begin], pos[begin], low, high), *out.flush()]) < 20
    assert covered([(1, t), (2, t[3:])]) == {2: [(0, len(t) - 3)]}


def test_hot_group_within_memory(tmp_path):
    """60,000 different rows around one anchor: what Python holds does not grow with them."""
    rng = np.random.default_rng(3)
    gram = rng.integers(97, 123, 20).astype(np.uint8)

    def batches(n):
        for at in range(0, n, 5000):
            tail = np.concatenate([np.tile(gram, (5000, 1)), rng.integers(97, 99, (5000, 30)).astype(np.uint8)], axis=1)
            back = rng.integers(97, 99, (5000, 30)).astype(np.uint8)
            ids, zero = np.arange(at, at + 5000), np.zeros(5000, dtype=np.int64)
            tail[:, 20:36] = np.unpackbits((ids.astype(">u2")).view(np.uint8).reshape(-1, 2), axis=1) + 97  # in order
            columns = [pa.array(zero.astype(np.int32)), pa.array(ids), pa.array(zero), pa.array(zero + 30), pa.array(zero + 30), pa.array(zero.astype(np.int16)), pa.array((zero + 30).astype(np.int16)), op7_repeats.fixed(back), op7_repeats.fixed(tail)]
            yield pa.RecordBatch.from_arrays(columns, names=[x.rpartition(" ")[0] for x in op7_repeats.SNIPPETS.split(", ")])

    def peak(n):
        tracemalloc.start()
        hits = sum(len(x[0]) for x in op7_repeats.Shard(50, 20, f"file://{tmp_path}", 1 << 20, 4096)(batches(n)))
        out = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return out, hits

    small, large = peak(30_000), peak(60_000)
    assert large[0] < 1.3 * small[0] and large[0] < 16 << 20 and large[1] > 0


def test_quality_of_odd_rows(spark, odd):
    model = op8_quality.fit(odd, spark.createDataFrame([], "doc_id long, quality int"))
    assert {r["s"] for r in op8_quality.score(odd, model, out="s").collect()} == {0.5}
    docs = spark.createDataFrame([(i, ("plain words here and there " if i % 2 else "BUY!! NOW!! %%% $$$ ") * (3 + i % 7)) for i in range(80)], "doc_id long, text string")
    model = op8_quality.fit(docs, docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality")))
    assert all((r["s"] > 0.5) == bool(r["doc_id"] % 2) for r in op8_quality.score(docs, model, out="s").collect())


def test_media_round_trip(spark, odd):
    rows = op9_media.media_columns(odd).collect()
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        t = (TEXTS[r["doc_id"]] if r["doc_id"] is not None else TEXTS[4]) or ""
        data = op9_media.from_wav(bytes(r["media"]))
        assert data.rstrip(b"\0") == t.encode() and len(data) % 64 == 0 and data and r["n_bytes"] == len(t.encode())
        assert list(r["fingerprint"]) == sorted(r["fingerprint"])


def test_short_texts_have_fingerprints():
    made = lambda t: op9_media.pairs(op9_media.peaks(np.frombuffer(op9_media.payload(t)[0], dtype=np.uint8)))
    rng = random.Random(17)
    texts = ["".join(rng.choices("abcdefghij klmnop", k=n)) for n in [*range(1, 70), 127, 128, 129, 255, 256, 257, 300, 511, 512, 513]]
    assert all(len(made(t)) for t in texts)
    long = [t for t in texts if len(t) > 20]
    assert len({made(t).tobytes() for t in long}) > len(long) // 3


def test_lengths_around_a_window_can_be_compared():
    """A text has the same pairs at its beginning whether it ends before or after a window's length."""
    made = lambda t: set(op9_media.pairs(op9_media.peaks(np.frombuffer(op9_media.payload(t)[0], dtype=np.uint8))).tolist())
    rng = random.Random(18)
    for _ in range(20):
        t = "".join(rng.choices("abcdefghij klmnop", k=250))
        assert made(t) & made(t + " " * 50) and made(t) & made(t + t)


def test_all_bytes_count_in_the_spectrum():
    rng = np.random.default_rng(19)
    for n in (64, 256, 320, 2048):
        weights = op9_media.frames_of(np.full(n, 129, dtype=np.uint8)).sum(axis=0)
        assert weights.shape[0] == op9_media.FRAME
        base = rng.integers(97, 122, n).astype(np.uint8)
        for k in (0, 1, 31, 32, n // 2, n - 2, n - 1):
            other = base.copy()
            other[k] = 0
            assert not np.allclose(op9_media.frames_of(base), op9_media.frames_of(other), atol=5)


def test_containment_of_odd_rows(spark, odd):
    items = spark.createDataFrame([(1, TEXTS[4]), (2, None), (3, "a"), (None, "a"), (3, "zzz")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in op10_decontaminate.contained_items(odd, items).collect()}
    assert got == {(4, 1), (5, 1), (3, 3)}
    assert op10_decontaminate.contained_items(odd.limit(0), items).count() == 0 == op10_decontaminate.contained_items(odd, items.limit(0)).count()


def test_repeats_of_lengths_that_do_not_fit(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    for length, gram in ((250, 200), (100, 36), (50, 51), (50, 0)):
        with pytest.raises(ValueError, match="length"):
            op7_repeats.remove_repeats(docs, length, gram=gram)
