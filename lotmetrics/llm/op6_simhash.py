"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints of 64 bits link at `bits` or fewer differing bits.  Correlated bits
(by a bounded sample of fingerprints) are grouped into partitions; dynamic
programming gives partition i a threshold t_i so that the sum of t_i + 1 is
bits + 1, with the least estimated probes and candidates: two fingerprints
within the distance differ by at most t_i in one partition i at least.  Probes
(half of the flips on either side) are joined by partition and value, and every
candidate's whole distance is verified.  Sample and estimates steer the cost
only; the links are exact.

Equal fingerprints are one node; where texts are compared too, equal fingerprints
with equal shingle sets.  Before all pairs are asked for, each bucket's members
are compared with its smallest one, and in crowded places all near fingerprints
with the middle one of the crowd.  Pairs inside a component are not formed: in a
bucket that one component fills, only the other members meet it.  So a large group
of near copies costs about its own size.

Where a similarity of texts is asked for, fingerprints only find the first links.
All other pairs meet by their sets' prefixes: in one order of all shingles, two
sets of the similarity share one of the first n - ceil(share * n) + 1 of their n
members.  Shingles that are common in a sample come last in that order, the most
common ones at the end.  Each set has a bitmap of 256 parities; two
sets differ in as many members at least as their bitmaps do in bits.  Pairs whose
sizes, bitmaps or number of shared prefix members rule the similarity out are not
compared; no pair that has it is lost, however far its fingerprints are apart.

Null texts are empty; texts without words have fingerprint 0 and link like any
other.  Rows of equal ids have their own fingerprints and ids count once in a
component; null ids never are a component's name (it is null if it has no other).
An empty table gives no rows.  Very long texts are hashed whole.  The query reads ids
and texts only, whatever other columns are called; dropping near copies keeps them all.
"""

import itertools
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialize, slices, table, without
from .graph import components

MASK = (1 << 64) - 1
#: The words of a set's bitmap: bit k tells whether an odd number of members has k as its low byte.
PARITIES = ("x0", "x1", "x2", "x3")


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """XXH64 (seed 42) of each run of words; of the whole sequence where it is shorter."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, dtype=np.uint64)
    flat = memoryview(b" ".join(found))
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    n = max(1, len(found) - words + 1)
    starts = np.concatenate([[0], ends[: n - 1] + 1]).tolist()
    lasts = ends[min(words, len(found)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(flat[a:b], 42) for a, b in zip(starts, lasts, strict=True)], dtype=np.uint64)


def fingerprint(hashes: np.ndarray, block: int = 1 << 16) -> int:
    """Bit k is 1 if it is set in over half the hashes."""
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), block):
        ones += np.unpackbits(hashes[at : at + block].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, words: int = 4, text: str = "text") -> DataFrame:
    """doc_id, fp (the 64 bits as a long)."""
    def made(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([signed(fingerprint(shingle_hashes(t, words))) for t in b.column(1).to_pylist()], pa.int64())], names=["doc_id", "fp"])

    return docs.select("doc_id", text).mapInArrow(made, "doc_id long, fp long")


def ball(width: int, radius: int) -> int:
    return sum(math.comb(width, r) for r in range(radius + 1))


def grouped(sample: np.ndarray, m: int) -> list[list[int]]:
    """64 bits in m groups; a group takes, one by one, the bit that is most correlated with it."""
    bits = np.unpackbits(sample.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(float)
    with np.errstate(divide="ignore", invalid="ignore"):
        c = np.abs(np.nan_to_num(np.corrcoef(bits, rowvar=False))) if len(sample) > 1 else np.zeros((64, 64))
    left, out = list(range(64)), []
    for k in range(m):
        size = (64 - sum(map(len, out)) + m - k - 1) // (m - k)
        own = [left.pop(0)]
        while len(own) < size:
            own.append(left.pop(int(np.argmax([c[own, b].sum() for b in left]))))
        out.append(sorted(own))
    return out


def allocate(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds t_i >= -1 whose t_i + 1 sum to total with the least cost; costs[i][t + 1]."""
    best = {0: (0.0, [])}
    for row in costs:
        after: dict[int, tuple[float, list[int]]] = {}
        for done, (cost, t) in best.items():
            for add, more in enumerate(row[: total - done + 1]):
                if done + add not in after or cost + more < after[done + add][0]:
                    after[done + add] = (cost + more, [*t, add - 1])
        best = after
    return best[total]


def plan(sample: np.ndarray, n: int, pairs: float, asks: int, bits: int) -> list[tuple[int, int, list[int]]]:
    """(mask, threshold, bit numbers) of each partition in use.

    n fingerprints send `asks` rows a flip; `pairs` of them share a band.  A
    candidate is compared in memory, a probe is shuffled and sorted: it counts a
    hundred times as much.
    """
    a = sample[:, None] ^ sample[None, :]
    a = a[np.triu_indices(len(sample), 1)]
    best = None
    for m in range(1, min(bits + 1, 8) + 1):
        groups = grouped(sample, m)
        costs = []
        for g in groups:
            near = np.bincount(np.bitwise_count(a & np.uint64(sum(1 << b for b in g))), minlength=65).cumsum() / max(1, len(a))
            row = [0.0]
            for t in range(min(bits, 5) + 1):
                chance = max(near[t], ball(len(g), t) / 2.0 ** len(g))
                row.append(n * (asks * ball(len(g), t - t // 2) + ball(len(g), t // 2)) + 0.01 * pairs * chance * math.comb(t, t // 2))
            costs.append(row)
        try:
            cost, t = allocate(costs, bits + 1)
        except KeyError:
            continue
        if best is None or cost < best[0]:
            best = (cost, [(sum(1 << b for b in g), k, g) for g, k in zip(groups, t, strict=True) if k >= 0])
    return best[1]


def probes(nodes: DataFrame, parts: list, side: int, extra: tuple[str, ...] = ()) -> DataFrame:
    """node, fp and bucket: a row for each flip of up to half the threshold, the larger half on side 0.

    A bucket is the hash of partition, value and band.  Where hashes clash there are
    more candidates.
    """
    flips = []
    for i, (mask, t, own) in enumerate(parts):
        radius = t - t // 2 if side == 0 else t // 2
        flips += [(i, signed(mask), signed(sum(1 << b for b in c))) for r in range(radius + 1) for c in itertools.combinations(own, r)]
    every = F.array(*[F.struct(F.lit(i).alias("part"), F.lit(m).cast("long").alias("mask"), F.lit(f).cast("long").alias("flip")) for i, m, f in flips])
    rows = nodes.select("node", "fp", *extra, "band", F.explode(every).alias("x"))
    key = F.col("fp").bitwiseAND(F.col("x.mask")).bitwiseXOR(F.col("x.flip"))
    return rows.select("node", "fp", *extra, F.xxhash64("x.part", key, "band").alias("bucket"))


def prefix_rows(known: DataFrame, prefixes: DataFrame) -> DataFrame:
    """node, n, root and bucket: a row for each member of a node's prefix that nodes of another root have in theirs."""
    one = prefixes.join(known, "node").where(F.col("doc_id") == F.col("low"))
    rows = one.select("node", "n", "root", F.explode("prefix").alias("bucket"))
    roots = W.partitionBy("bucket")
    rows = rows.withColumns({"least": F.min("root").over(roots), "most": F.max("root").over(roots)})
    return rows.where(F.col("least") < F.col("most")).select("node", "n", "root", "bucket").distinct()


def near(a: str, b: str, bits: int):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= bits


def least_shared(n, share: float):
    """The members that a set of n shares with a set of the similarity at least."""
    return F.ceil(n * F.lit(share) - F.lit(1e-6))


def hubs(at: DataFrame, hot: int) -> DataFrame:
    """node and fp of the middle member of each bucket of `hot` or more: the nearest one to the majority of each bit."""
    many = materialize(at.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") >= hot), "many")
    rows = materialize(at.join(many, "bucket"), "crowd")
    ones = [F.sum(F.shiftrightunsigned("fp", k).bitwiseAND(F.lit(1))).alias(f"b{k}") for k in range(64)]
    middle = sum((F.shiftleft((2 * F.col(f"b{k}") > F.col("n")).cast("long"), k) for k in range(64)), F.lit(0).cast("long"))
    middle = materialize(rows.groupBy("bucket", "n").agg(*ones).select("bucket", middle.alias("middle")), "middles")
    off = F.bit_count(F.col("fp").bitwiseXOR(F.col("middle")))
    best = rows.join(middle, "bucket").groupBy("bucket").agg(F.min(F.struct(off.alias("off"), "node", "fp")).alias("x"))
    return materialize(best.select("x.node", "x.fp").distinct(), "hubs")


def links_of(nodes: DataFrame, bits: int, verify=None, share: float | None = None, prefixes: DataFrame | None = None, sample: int = 1024, hot: int = 64) -> DataFrame:
    """Roots (node, root) of the nodes that have a link.

    nodes: node (unique), fp, band (0 without a share) and, with a share, n, low and PARITIES.
    With a share, pairs within `bits` in neighbouring bands are only the first links
    and prefixes (node, doc_id, prefix) find the rest; without, all pairs within
    `bits` link.
    verify: pairs (a, b) of nodes to those that count, by default all of them.
    """
    verify = verify or (lambda pairs: pairs)
    reach = 0 if share is None else 1
    per_band = {r["band"]: r["count"] for r in nodes.groupBy("band").count().collect()}  # a few dozen rows: bands are logarithms
    n = sum(per_band.values())
    meet = sum(c * (c / 2 + (per_band.get(b - 1, 0) if reach else 0)) for b, c in per_band.items())
    some = nodes.where(F.pmod(F.xxhash64("fp"), F.lit(1 << 20)) < F.lit(math.ceil(sample / max(n, 1) * (1 << 20)))).select("fp").limit(4 * sample).collect()
    drawn = np.array(sorted(r["fp"] & MASK for r in some) or [0], dtype=np.uint64)
    parts = plan(drawn, n, meet, 1 + reach, bits)
    # each bucket's members to its smallest one
    at = materialize(probes(nodes, [(sum(1 << b for b in g), 0, g) for g in grouped(drawn, 4)], 1), "at")
    low = at.groupBy("bucket").agg(F.min(F.struct("node", "fp")).alias("low"), F.count("*").alias("n")).where("n > 1").drop("n")
    stars = at.join(low, "bucket").where((F.col("node") != F.col("low.node")) & near("fp", "low.fp", bits)).select(F.col("low.node").alias("a"), F.col("node").alias("b"))
    # in crowded places all members to the middle one
    middle = hubs(at, hot)
    if not middle.isEmpty():
        middle = nodes.join(middle.select("node"), "node", "left_semi")
        around = probes(nodes, parts, 1, ("band",)).select(F.col("node").alias("b"), F.col("fp").alias("fp2"), "bucket")
        asked = middle.withColumn("band", F.explode(F.sequence(F.col("band") - reach, F.col("band") + reach)))
        to = probes(asked, parts, 0).join(around, "bucket").where((F.col("node") != F.col("b")) & near("fp", "fp2", bits)).select(F.col("node").alias("a"), "b")
        stars = stars.unionByName(materialize(to.distinct(), "spokes"))
    stars = materialize(verify(stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()), "stars")
    first = components(stars)
    known = nodes.join(first, "node", "left").withColumn("root", F.coalesce("root", "node"))
    if share is None:
        extra = ("fp", "root")
        known = materialize(known.select("node", "band", *extra), "first")
        index, asks = probes(known, parts, 1, ("root",)), probes(known, parts, 0, ("root",))
    else:
        extra = ("n", "root", *PARITIES)
        known = materialize(known.select("node", "low", "n", "root"), "first")
        index = asks = materialize(prefix_rows(known, prefixes).join(nodes.select("node", *PARITIES), "node"), "members")
    # the component that fills a bucket, if one does
    large = materialize(first.groupBy("root").agg(F.count("*").alias("n")).where(F.col("n") >= hot).select("root"), "large")
    keep, full = ("node", *extra, "bucket"), None
    if not large.isEmpty():
        members = probes(known.join(large, "root", "left_semi"), parts, 1, ("root",)) if share is None else index.join(large, "root", "left_semi")
        per = members.groupBy("bucket", "root").agg(F.count("*").alias("n"))
        full = materialize(per.groupBy("bucket").agg(F.max_by("root", "n").alias("full"), F.max("n").alias("n")).where(F.col("n") >= hot).drop("n"), "full")
    if full is None or full.isEmpty():
        index, asks = index.withColumn("inside", F.lit(False)), asks.withColumn("inside", F.lit(False))
    else:
        inside = F.coalesce(F.col("root") == F.col("full"), F.lit(False))
        index = index.join(full, "bucket", "left").select(*keep, inside.alias("inside"))
        places = F.when(F.col("full").isNull() | inside, F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True)))
        asks = asks.join(full, "bucket", "left").select(*keep, F.explode(places).alias("inside"))
    other = index.select("bucket", "inside", *[F.col(c).alias(f"{c}2") for c in ("node", *extra)])
    # either order finds a pair, so the smaller node asks
    both = (F.col("root") != F.col("root2")) & (F.col("node") < F.col("node2"))
    if share is None:
        pairs = asks.join(other, ["bucket", "inside"]).where(both & near("fp", "fp2", bits)).select(F.col("node").alias("a"), F.col("node2").alias("b")).distinct()
    else:
        sizes = F.least("n", "n2") >= F.greatest("n", "n2") * F.lit(share) - F.lit(1e-6)
        needed = (F.col("n") + F.col("n2")) * F.lit(share / (1 + share)) - F.lit(1e-6)  # shared members of a pair that has the similarity
        apart = sum((F.bit_count(F.col(x).bitwiseXOR(F.col(f"{x}2"))) for x in PARITIES), F.lit(0))
        met = asks.join(other, ["bucket", "inside"]).where(both & sizes & (apart <= F.col("n") + F.col("n2") - 2 * needed))
        met = met.groupBy(F.col("node").alias("a"), F.col("node2").alias("b")).agg(F.count("*").alias("c"), F.min("n").alias("n"), F.min("n2").alias("n2"))
        # up to the end of the prefix that ends first all shared members are counted; the rest of its set may be shared
        most = F.col("c") + F.greatest(least_shared(F.col("n"), share), least_shared(F.col("n2"), share)) - 1
        pairs = met.where(most >= needed)
    pairs = verify(pairs.select("a", "b"))
    return components(stars.unionByName(pairs.select("a", "b")))


def near_components(prints: DataFrame, bits: int = 4, verify=None, share: float | None = None) -> DataFrame:
    """prints: doc_id, fp and, with a share, node, n, prefix and PARITIES. Adds component_id, the smallest id reachable."""
    if share is None:
        prints = materialize(prints.select("doc_id", "fp", F.col("fp").alias("node")), "prints")
        nodes = prints.groupBy("node").agg(F.min("fp").alias("fp"), F.min("doc_id").alias("low")).withColumn("band", F.lit(0))
    else:
        # a little over 1 / share, so that rounding never puts similar sets two bands apart
        band = F.floor(F.log(F.greatest("n", F.lit(1))) / F.lit(math.log(1.001 / share))).cast("int")
        nodes = prints.groupBy("node").agg(F.min("doc_id").alias("low"), *[F.min(c).alias(c) for c in ("fp", "n", *PARITIES)]).withColumn("band", band)
    nodes = materialize(nodes, "nodes")
    roots = links_of(nodes, bits, verify, share, None if share is None else prints.select("node", "doc_id", "prefix"))
    joined = nodes.join(roots, "node")
    names = materialize(joined.groupBy("root").agg(F.min("low").alias("name")), "names")
    linked = materialize(joined.select("node", "root").join(names, "root").select("node", "name"), "linked")
    named = materialize(nodes.join(linked, "node", "left").select("node", F.coalesce("name", "low").alias("component_id")), "components")
    return prints.join(named, "node").select("doc_id", "fp", "component_id")


def op6_generalised_pigeonhole(spark, sf_dir: str) -> DataFrame:
    rows = near_components(fingerprints(table(spark, sf_dir, "documents")))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def set_of(hashes: np.ndarray) -> np.ndarray:
    return np.unique(hashes)


def name_of(found: np.ndarray, fp: int) -> int:
    """The node of a shingle set and fingerprint, as a long."""
    return signed(xxhash.xxh64_intdigest(found.tobytes() + fp.to_bytes(8, "little"), 7))


def parities(found: np.ndarray) -> list[int]:
    """The bitmap of a set in four words."""
    odd = np.bincount((found & np.uint64(0xFF)).astype(np.int64), minlength=256) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8").tolist()


def common_shingles(docs: DataFrame, words: int = 5, text: str = "text", sample: int = 16_384, least: int = 3, most: int = 1 << 16) -> tuple[np.ndarray, np.ndarray]:
    """Ascending hashes of the shingles that `least` of about `sample` different texts hold (the `most` most frequent ones), and how many hold them."""
    def made(batches):
        for b in slices(batches):
            sets = [set_of(shingle_hashes(t, words)) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, dtype=np.uint64), *sets]).view(np.int64))], names=["h"])

    drawn = F.pmod(F.xxhash64("doc_id", text), F.lit(1 << 20)) < F.lit(math.ceil(sample / max(docs.count(), 1) * (1 << 20)))
    held = docs.where(drawn).select(text).distinct().mapInArrow(made, "h long").groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    rows = sorted((r["h"] & MASK, r["n"]) for r in held.orderBy(F.desc("n"), "h").limit(most).collect())
    return np.array([h for h, _ in rows], dtype=np.uint64), np.array([n for _, n in rows], dtype=np.int64)


def prefix_of(found: np.ndarray, share: float, common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The first members of a set in the order of hashes, the common ones last by how common they are: sets of the similarity share one at least."""
    hashes, counts = common
    if len(hashes):
        at = np.minimum(np.searchsorted(hashes, found), len(hashes) - 1)
        found = found[np.lexsort((found, np.where(hashes[at] == found, counts[at], 0)))]
    return found[: len(found) - math.ceil(share * len(found) - 1e-6) + 1]


def described(docs: DataFrame, words: int = 5, share: float = 0.8, text: str = "text") -> DataFrame:
    """doc_id, fp, node, n (different shingles), prefix and PARITIES: what links_of compares before it asks for texts."""
    common = common_shingles(docs, words, text)

    def made(batches):
        for b in slices(batches):
            rows = []
            for t in b.column(1).to_pylist():
                hashes = shingle_hashes(t, words)
                fp, found = fingerprint(hashes), set_of(hashes)
                rows.append((signed(fp), name_of(found, fp), len(found), prefix_of(found, share, common).view(np.int64), *parities(found)))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), *[pa.int64()] * len(PARITIES)]
            columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]], names=["doc_id", "fp", "node", "n", "prefix", *PARITIES])

    return docs.select("doc_id", text).mapInArrow(made, "doc_id long, fp long, node long, n long, prefix array<long>, " + ", ".join(f"{x} long" for x in PARITIES))


def jaccard_verifier(docs: DataFrame, prints: DataFrame, words: int = 5, share: float = 0.8):
    """Keeps the node pairs whose shingle sets have the similarity.

    prints: doc_id, node.  Only the texts of asked nodes are hashed, one document
    for each; the sets travel as sorted arrays.  Nodes that only null ids have are
    linked to nothing.
    """
    def sets(batches):
        for b in batches:
            rows = []
            for node, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                hashes = shingle_hashes(t, words)
                found = set_of(hashes)
                if name_of(found, fingerprint(hashes)) == node:  # not another text of the same id
                    rows.append({"node": node, "set": found.tobytes()})
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("node", pa.int64()), ("set", pa.binary())]))

    def alike(batches):
        for b in slices(batches):
            keep = []
            for x, y in zip(b.column("one").to_pylist(), b.column("two").to_pylist(), strict=True):
                x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both >= share * (len(x) + len(y) - both) - 1e-9)
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    low = materialize(prints.groupBy("node").agg(F.min("doc_id").alias("low")).where("low is not null"), "low")

    def verify(pairs: DataFrame) -> DataFrame:
        pairs = materialize(pairs.select("a", "b"), "pairs")
        asked = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
        of = materialize(low.join(asked, "node", "left_semi"), "asked")
        texts = docs.select("doc_id", "text").join(of, F.col("doc_id") == F.col("low")).select("node", "text")
        made = materialize(texts.mapInArrow(sets, "node long, set binary").dropDuplicates(["node"]), "sets")
        one, two = (made.select(F.col("node").alias(c), F.col("set").alias(s)) for c, s in (("a", "one"), ("b", "two")))
        return pairs.join(one, "a").join(two, "b").select("a", "b", "one", "two").mapInArrow(alike, "a long, b long")

    return verify


def drop_near_copies(docs: DataFrame, words: int = 5, share: float = 0.8, bits: int = 10) -> DataFrame:
    """docs without the near copies of a document with a smaller id, in any number of steps.

    All pairs of the Jaccard similarity count; `bits` only tells which ones the
    fingerprints find first.  Rows that share an id stay or go together; rows of a
    null id stay.  All columns stay, whatever their names.
    """
    prints = materialize(described(docs, words, share), "prints")
    found = near_components(prints, bits, jaccard_verifier(docs, prints, words, share), share)
    return without(docs, materialize(found.where("doc_id <> component_id").select("doc_id").distinct(), "gone"))
