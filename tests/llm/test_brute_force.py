"""Results that SQL cannot state, against plain and slow computations, and odd tables."""

import cmath
import collections
import math
import random
import re
import zlib

import pytest
import xxhash
import zstandard
from pyspark.sql import functions as F

from lotmetrics.llm import common, op2_packing, op3_language, op4_chat, op5_pii, op6_simhash, op7_repeats, op8_quality, op9_media, op10_decontaminate

DIR = "/root/testdata/sf0.001"


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split(r"[ \t\n\x0b\x0c\r]+", low) if w]


def runs_of(text, k):
    w = words(text)
    return [" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))] if w else []


def documents(spark):
    return [(r["doc_id"], r["text"], r["lang"]) for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()]


def test_fingerprints_by_hand(spark):
    docs = [*documents(spark), (-1, None, None), (-2, " \n", None), (-3, "Ab É", None)]
    got = {r["doc_id"]: r["fp"] % (1 << 64) for r in op6_simhash.fingerprints(spark.createDataFrame(docs, "doc_id long, text string, lang string")).collect()}
    for i, t, _ in docs:
        hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in runs_of(t, 4)]
        assert got[i] == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_batches_fill_their_buckets(spark):
    docs = documents(spark)
    rows = op2_packing.pack(spark.createDataFrame(docs, "doc_id long, text string, lang string"), buckets=4, budget=2000, rows_a_shard=13).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(i for i, _, _ in docs)
    n = {i: len(words(t)) for i, t, _ in docs}
    ends = sorted({r["bucket_len"] for r in rows})
    groups = collections.defaultdict(list)
    for r in rows:
        assert r["n_tokens"] == n[r["doc_id"]] and r["bucket_len"] == min(e for e in ends if e >= r["n_tokens"]) and r["padding"] == r["bucket_len"] - r["n_tokens"]
        groups[r["bucket"], r["bucket_len"]].append((r["batch"], r["slot"]))
    for (_, end), places in groups.items():
        fit = max(1, 2000 // max(1, end))
        assert sorted(places) == [divmod(k, fit) for k in range(len(places))]


def test_boundaries_of_many_lengths():
    rng = random.Random(2)
    lengths = sorted(rng.sample(range(10_000), 150))
    counts = [rng.randint(1, 30) for _ in lengths]
    best = {(0, 0): 0}
    for k in range(1, 7):  # the least cost of the first j lengths in k buckets
        for j in range(1, len(lengths) + 1):
            costs = [best[k - 1, i] + lengths[j - 1] * sum(counts[i:j]) for i in range(j) if (k - 1, i) in best]
            if costs:
                best[k, j] = min(costs)
    ends = op2_packing.boundaries(lengths, counts, 6)
    assert sum(c * min(e for e in ends if e >= x) for x, c in zip(lengths, counts)) == min(best[k, len(lengths)] for k in range(1, 7))


def bits_by_hand(samples, text, order):
    """Code length by counting contexts in dictionaries, byte by byte."""
    seen = [collections.defaultdict(collections.Counter) for _ in range(order + 1)]
    for t in samples:
        data = b"\n" * order + t.encode()
        for at in range(order, len(data)):
            for k in range(order + 1):
                seen[k][data[at - k : at]][data[at]] += 1
    data, out = b"\n" * order + text.encode(), 0.0
    for at in range(order, len(data)):
        for k in range(order, -1, -1):
            here = seen[k].get(data[at - k : at])
            if here is None:
                continue
            n, d = sum(here.values()), len(here)
            if data[at] in here:
                out -= math.log2(here[data[at]] / (n + d))
                break
            out -= math.log2(d / (n + d))
        else:
            out += 8
    return out


def test_code_lengths_by_counting(spark):
    samples = {"x": ["the cat sat on the mat", "then the cat ran"], "y": ["o gato sentou no tapete", "não há gato"]}
    trees = op3_language.Trees(samples)
    texts = ["the cat", "o gato é", "zzz", "a", "then o mat"]
    rows = {r["doc_id"]: r for r in op3_language.predict(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), trees).collect()}
    for i, t in enumerate(texts):
        bits = [bits_by_hand(samples[x], t, op3_language.ORDER) for x in "xy"]
        assert rows[i]["lang_pred"] == "xy"[bits.index(min(bits))]
        assert abs(rows[i]["score"] - 1 / sum(2 ** (min(bits) - b) for b in bits)) < 1e-4


def test_quality_scores_by_compressing(spark):
    docs = spark.createDataFrame(documents(spark), "doc_id long, text string, lang string")
    model = op8_quality.fit(docs, spark.read.parquet(f"{DIR}/labels.parquet"))
    assert model.good and model.bad

    def size(raw, content):
        c = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_AUTO), write_content_size=False, write_dict_id=False)
        return sum(len(c.compress(raw[i : i + 1024])) for i in range(0, len(raw), 1024))

    for r in op8_quality.score(docs, model, out="s").limit(25).collect():
        raw = (r["text"] or "").encode()
        a, b = size(raw, model.good), size(raw, model.bad)
        x = model.slope * ((a - b) / (a + b) if raw else 0.0) + model.offset
        assert abs(r["s"] - 1 / (1 + math.exp(-x))) < 1e-9


def peaks_by_hand(data):
    """Peaks by the definition of the discrete Fourier transform."""
    n = op9_media.FRAME
    window = [0.5 - 0.5 * math.cos(2 * math.pi * k / n) for k in range(n)]
    edges = [int(1 + (n // 2) * k / 4) for k in range(5)]
    out = []
    for frame in range(-(-len(data) // (n // 2)) + 1):
        begin = (frame - 1) * (n // 2)
        x = [((data[begin + k] - 128) if 0 <= begin + k < len(data) else 0) * window[k] for k in range(n)]
        power = [abs(sum(v * cmath.exp(-2j * math.pi * f * k / n) for k, v in enumerate(x))) for f in range(n // 2 + 1)]
        mean = sum(power[1:]) / (n // 2)
        row = []
        for a, b in zip(edges, edges[1:]):
            top = max(range(a, b), key=lambda f: power[f])
            row.append(top if power[top] > 1.5 * mean else -1)
        out.append(row)
    return out


def test_features_by_definition(spark):
    texts = ["short text of one window", "a longer text, " * 25 + "with an end", "", "0123456789" * 30]
    rows = op9_media.media_columns(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for r in rows:
        found = peaks_by_hand(op9_media.payload(texts[r["doc_id"]])[0])
        want = sorted(t << 24 | f1 << 16 | found[t + dt][j] << 8 | dt for t, row in enumerate(found) for k, f1 in enumerate(row) if f1 >= 0 for dt in (1, 2, 3) if t + dt < len(found) for j in (k - 1, k, k + 1) if 0 <= j < 4 and found[t + dt][j] >= 0)
        assert list(r["fingerprint"]) == want


def test_conversation_is_read_as_one_text(spark):
    rows = [(7, k, role, text) for k, (role, text) in enumerate([("user", "### User: a</turn>\n"), ("assistant", "b</turn>\n### "), ("tool", ""), ("assistant", "\\")])]
    segments = op4_chat.format_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    text = op4_chat.assemble(segments).first()["formatted"]
    assert op4_chat.parse(text) == [(role, t) for _, _, role, t in rows]
    assert op4_chat.read_back(segments).first()["formatted_chars"] == len(text)


EMPTY = "doc_id long, text string, lang string, source string, n_chars long"


def test_empty_tables(spark):
    docs = spark.createDataFrame([], EMPTY)
    assert op3_language.fit(docs) is None and op3_language.predict(docs, None).count() == 0
    assert op4_chat.read_back(op4_chat.format_turns(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).count() == 0
    assert op5_pii.redact_pii(docs).count() == 0 == op7_repeats.remove_repeats(docs).count() == op9_media.media_columns(docs).count()
    model = op8_quality.fit(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert op8_quality.score(docs, model).count() == 0


def test_clashing_columns_and_long_rows(spark):
    long = "word " * 300_000 + "end"
    docs = spark.createDataFrame([(1, "one two three four five six a@b.cd", 5, 6, 7, 8.0, 9), (2, None, 1, 1, 1, 1.0, 1), (3, long, 1, 1, 1, 1.0, 1), (4, long, 1, 1, 1, 1.0, 1), (None, long, 1, 1, 1, 1.0, 1)], "doc_id long, text string, _id int, _y int, _gone int, score double, _score int")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1), (1, 1)], "doc_id long, quality int")
    model = op8_quality.fit(docs, labels)
    assert op8_quality.score(docs, model).select("doc_id", "score", "_score").count() == 5
    kept = op6_simhash.drop_near_copies(docs)
    assert kept.columns == docs.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "3", "None"]
    assert common.free_name(docs, "_Score") == "_Score_" and common.without(docs, docs.select("doc_id").limit(0)).count() == 5
    assert op5_pii.redact_pii(docs).where("doc_id = 1").first()["text"].endswith("[EMAIL]")
    assert {r["doc_id"]: r["n_removed"] for r in op7_repeats.remove_repeats(docs).mapInArrow(op7_repeats._digests, op7_repeats.DIGESTS).collect()} == {1: 0, 2: 0, 3: 0, 4: len(long), None: 0}
    assert op3_language.predict(docs, None).count() == 5 == op9_media.media_columns(docs.where("doc_id < 3 or doc_id is null")).count() + 2
    assert op10_decontaminate.contained_items(docs, spark.createDataFrame([(1, long)], "item_id long, text string")).select("doc_id").distinct().count() == 2


def test_base_spans_of_a_table(spark):
    rows = [(1, "x@y.zz 1.2.3.4"), (2, None), (1, "x@y.zz 1.2.3.4"), (3, "")]
    out = op5_pii.redact_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["text"]) for r in out if r["text"]) == [(1, "[EMAIL] [IP]")] * 2 and len(out) == 4


@pytest.mark.parametrize("odd", [False, True])
def test_pipeline_by_brute_force(spark, tmp_path, odd):
    import corpus_pipeline

    held = documents(spark)
    if odd:
        spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
        for t in ("labels", "benchmark"):
            spark.read.parquet(f"{DIR}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
        assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
        return
    rng = random.Random(9)
    clean = [t for _, t, _ in held if t and 40 < len(words(t)) < 400][:30]
    near = []
    for t in clean:  # planted copies on either side of the similarity
        for share in (0.02, 0.1, 0.3):
            w = t.split(" ")
            near.append(" ".join(w[: len(w) - int(share * len(w))] + [f"z{rng.randint(0, 99)}" for _ in range(int(share * len(w) / 2))]))
    docs = [*held, *((10_000 + k, t, "en") for k, t in enumerate(near)), (None, clean[0], "en"), (5, clean[1], "en"), (20_000, None, None), (20_001, "", None)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string").selectExpr("doc_id", "text", "lang", "'s' source", "cast(length(text) as bigint) n_chars").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{DIR}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    crc = lambda i: zlib.crc32(str(i).encode()) % 4
    model = op8_quality.fit(spark.createDataFrame([d[:2] for d in docs if d[0] is not None and crc(d[0]) != 2], "doc_id long, text string"), spark.read.parquet(f"{DIR}/labels.parquet").where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2))
    kept = [(i, t) for i, t, _ in docs if model.score(t) >= 0.7]
    sets = [set(runs_of(t, 5)) for _, t in kept]
    parent = list(range(len(kept)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(kept)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if kept[a][0] == kept[b][0] or kept[a][1] == kept[b][1] or both >= 0.8 * (len(sets[a]) + len(sets[b]) - both) - 1e-9:
                if None not in (kept[a][0], kept[b][0]):
                    parent[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(kept):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    kept = [(i, t) for k, (i, t) in enumerate(kept) if i is None or least[find(k)] == i]
    items = [set(runs_of(r["text"], 5)) for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
    bad = {i for i, t in kept if i is not None and any(s and len(s & set(runs_of(t, 5))) >= 0.8 * len(s) - 1e-9 for s in items)}
    kept = [(i, t) for i, t in kept if i not in bad]
    cues = op5_pii.automaton()
    want = sorted((str(i), len(words(op5_pii.redact(t or "", cues)))) for i, t in kept)
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in got) == want
    assert len(bad) > 0 and len(want) < len(docs)
