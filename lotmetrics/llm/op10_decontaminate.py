"""Benchmark decontamination: which documents hold most of a test item. DataFrame functions only.

Texts are lower-cased (A-Z) words; shingles are five words joined by spaces (a
shorter text is one shingle, a text without words has none).  An item is in a
document when at least `share` of its distinct shingles are in the document.

Items are partitioned by size, so that each partition [2^k, 2^(k+1)) keeps a
MinHash sketch of its own length: the n - ceil(share * n) + 1 smallest hashes of
the item with the partition's largest n, at most the item's own number.  A
document that holds the share of an item holds one of these at least, so probing
the sketches with all of a document's hashes finds every such pair; containment
of the whole shingle sets, as strings, then decides.

The sketches are joined by Spark's own size-checked broadcast, or by a shuffle
of the document hashes where they are larger.  Null and empty texts match
nothing; rows with equal ids are judged each and the best share is reported once
for an id; null ids match nothing.  No items or no documents give no rows.  Very long
documents are searched whole; other columns are not read, whatever their names.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, materialize, table


def once(value: Column, use) -> Column:
    """use(value), with value computed once a row however often use names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def words_of(text: Column) -> Column:
    """The words of a text; none for null."""
    spaced = F.trim(F.translate(F.coalesce(text, F.lit("")), UPPER + "\t\n\x0b\x0c\r", LOWER + " " * 5))
    return F.when(spaced == "", F.array().cast("array<string>")).otherwise(F.split(spaced, " +"))


def windows(words: Column, k: int, made) -> Column:
    """made(k words) for each run of k words; of all words where they are fewer; none without words."""
    def of(w: Column) -> Column:
        return F.when(F.size(w) == 0, F.slice(F.array(made(w)), 1, 0)).otherwise(F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - k + 1, F.lit(1))), lambda i: made(F.slice(w, i, k))))

    return once(words, of)


def shingles_of(words: Column, k: int) -> Column:
    return windows(words, k, lambda w: F.array_join(w, " "))


def hashes_of(words: Column, k: int) -> Column:
    """The shingles' hashes, each a hash of its words' hashes."""
    return windows(F.transform(words, lambda w: F.xxhash64(w)), k, lambda w: F.xxhash64(w))


def sketches(items: DataFrame, k: int = 5, share: float = 0.8) -> DataFrame:
    """item_id, band (the size partition), n (distinct shingles) and hash, a row for each value of the sketch."""
    sized = items.where("item_id is not null").select("item_id", F.array_sort(F.array_distinct(hashes_of(words_of(F.col("text")), k))).alias("h")).where(F.size("h") > 0)
    band = F.floor(F.log2(F.size("h"))).cast("int")
    top = F.pow(F.lit(2), band + 1) - 1  # the partition's largest size
    length = (top - F.ceil(top * F.lit(share) - F.lit(1e-9)) + 1).cast("int")
    return sized.select("item_id", band.alias("band"), F.size("h").alias("n"), F.explode(F.slice("h", 1, F.greatest(F.lit(1), length))).alias("hash"))


def contained_items(docs: DataFrame, items: DataFrame, k: int = 5, share: float = 0.8) -> DataFrame:
    """doc_id, item_id, n_shared, n_item, containment."""
    index = materialize(sketches(items, k, share).select("item_id", "hash"), "sketches")
    probes = docs.where("doc_id is not null").select("doc_id", F.explode(hashes_of(words_of(F.col("text")), k)).alias("hash"))
    found = materialize(probes.join(index, "hash").select("doc_id", "item_id").distinct(), "candidates")
    ids = found.select(F.col("doc_id").alias("_doc")).distinct()
    asked = items.where("item_id is not null").select(F.col("item_id").alias("_item"), F.array_distinct(shingles_of(words_of(F.col("text")), k)).alias("_theirs"))
    near = docs.select("doc_id", "text").join(ids, F.col("doc_id") == F.col("_doc"), "left_semi").select("doc_id", words_of(F.col("text")).alias("_words"))
    both = near.join(found, "doc_id").join(asked, F.col("item_id") == F.col("_item"))
    shared = F.size(F.array_intersect("_theirs", shingles_of(F.col("_words"), k)))
    rows = both.select("doc_id", "item_id", shared.cast("long").alias("n_shared"), F.size("_theirs").cast("long").alias("n_item"))
    rows = rows.groupBy("doc_id", "item_id").agg(F.max(F.struct(F.col("n_shared") / F.col("n_item"), "n_shared", "n_item")).alias("x"))
    rows = rows.select("doc_id", "item_id", "x.n_shared", "x.n_item", (F.col("x.n_shared") / F.col("x.n_item")).alias("containment"))
    return rows.where(F.col("n_shared") >= F.col("n_item") * F.lit(share) - F.lit(1e-9))


def op10_containment(spark, sf_dir: str) -> DataFrame:
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL = r"""
with w as (select 'd' kind, doc_id id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') w, row_number() over () r from documents where doc_id is not null
  union all select 'i', item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> ''), row_number() over () from benchmark where item_id is not null),
g as (select kind, id, r, unnest(list_transform(range(0, greatest(1, len(w) - 4)), lambda i: array_to_string(w[i + 1:i + 5], ' '))) s from w where len(w) > 0),
d as (select distinct id, r, s from g where kind = 'd'), i as (select distinct id, r, s from g where kind = 'i'),
n as (select id, r, count(*) n from i group by 1, 2),
c as (select d.id doc_id, d.r, i.id item_id, i.r ir, count(*) k from d join i on i.s = d.s group by 1, 2, 3, 4)
select doc_id, item_id, arg_max(k, k / n) n_shared, arg_max(n, k / n) n_item, max(k / n) containment from c join n on n.id = c.item_id and n.r = c.ir where k >= n * 0.8 - 1e-9 group by 1, 2
"""
