"""Spelling variants: words that differ by one code point, by a rare-first prefix filter.

1. Words and their occurrences are counted (partial counts before the shuffle).
2. A word's bigrams carry their positions.  All bigrams are ordered by the number of
   words that have them, the rarest first (ties: by the bigram).  One inserted,
   deleted or replaced code point touches at most two bigrams of a word, so the
   first untouched one is among the three rarest of both words: only these three
   meet.
3. Positions are limited exactly: a replaced code point moves nothing, so equally
   long words meet at equal positions; a word one longer has the bigram at the same
   position if it grew after it, and at the next if before.  So both words agree on
   all of the untouched side, and on half of the other: length, position and these
   letters are the join key (meeting_keys), without which words by the million with
   some rare bigram in common would meet.
4. What meets is verified by the edit distance.

Null and empty texts have no words.  Repeated rows count each.  Null ids are kept as
an empty id.  Texts of any length are read whole.  No table rows give no rows.
Other columns are not read, whatever their names.  A key that very many words share
is split by Spark's skew join; no task takes it whole and no partner is dropped.
"""

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blocks, materialize, table

#: Runs of letters of lower-cased text (only A to Z are lower-cased) as UTF-8: a to z, U+00C0 to U+00FF.
LETTERS = re.compile(rb"(?:[a-z]+|(?:\xc3[\x80-\xbf])+)+")
#: Different words whose counts a task holds at once.
HELD = 200_000


def unchanged(_doc: str | None):
    return None


def word_counts(docs: DataFrame, min_chars: int = 7, least: int = 2, text: str = "text", doc_id: str = "doc_id", change=unchanged, block: int = 4 << 20) -> DataFrame:
    """word, n: the words of at least min_chars code points that occur `least` times or more.

    change(id) gives a function that replaces a document's words before they are counted, by none that are longer, or None.
    """

    def count(batches):
        held: dict[bytes, int] = {}

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

        for b in blocks(batches, block):
            for t, doc in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                turn = change(doc)
                for w, n in Counter(LETTERS.findall(t.lower())).items() if t else ():
                    if len(w) >= min_chars:
                        if turn is not None:
                            w = turn(w)
                        if len(w) >= min_chars and (len(w) >= 2 * min_chars or w.isascii() or len(w.decode()) >= min_chars):
                            held[w] = held.get(w, 0) + n
                if len(held) >= HELD:
                    yield out()
                    held.clear()
        yield out()

    rows = docs.select(F.col(text).cast("binary").alias("_text"), F.col(doc_id).cast("string").alias("_id")).mapInArrow(count, "word binary, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select(F.col("word").cast("string").alias("word"), "n")


def prefixes(words: DataFrame, size: int = 3) -> DataFrame:
    """word, length, pos (from 0): where each word's `size` rarest bigrams begin. Every word has so many bigrams at least."""
    grams = F.transform(F.sequence(F.lit(1), F.char_length("word") - 1), lambda i: F.col("word").substr(i, F.lit(2)))
    rarity = words.select(F.explode(F.array_distinct(grams)).alias("gram")).groupBy("gram").agg(F.count("*").alias("words"))
    rarity = materialize(rarity, "rarity")  # of known size: Spark broadcasts it where it is small
    ranked = words.select("word", F.posexplode(grams).alias("pos", "gram")).join(rarity, "gram").groupBy("word").agg(F.array_sort(F.collect_list(F.struct("words", "gram", "pos"))).alias("grams"))
    return ranked.select("word", F.char_length("word").alias("length"), F.explode(F.transform(F.slice("grams", 1, size), lambda g: g["pos"])).alias("pos"))


def meeting_keys(longer: bool, enough: int = 5) -> Column:
    """The join keys of a word for one of its rare bigrams (columns word, length, pos).

    The touched code point is after the bigram or before it, so two near words agree on
    all of the other side up to the bigram's end. Where that is less than `enough`
    code points, the touched side is halved as well: they agree on one of its halves.
    `longer`: the keys by which a word one longer meets, so that both sides cut alike.
    """
    d = 1 if longer else 0
    word, p, n = F.col("word"), F.col("pos"), F.col("length")
    head = lambda k: F.substr(word, F.lit(1), k)
    tail = lambda k: F.substr(word, n - k + 1, k)
    key = lambda side, *parts: F.xxhash64(F.lit(side), n - d, *parts)
    rest = n - d - p - 2
    after = F.when(p + 2 >= enough, F.array(key("after", p, head(p + 2)))).otherwise(F.array(key("after, late", p, head(p + 2 + F.floor(rest / 2).cast("int"))), key("after, early", p, head(p + 2), tail(rest - F.floor(rest / 2).cast("int")))))
    own = p - d
    half = F.floor(own / 2).cast("int")
    before = F.when(n - p >= enough, F.array(key("before", own, tail(n - p)))).otherwise(F.array(key("before, late", own, head(half), tail(n - p)), key("before, early", own, tail(n - p + own - half))))
    none = F.array().cast("array<bigint>")
    return F.concat(F.when(rest >= (0 if longer else 1), after).otherwise(none), F.when(own >= 0, before).otherwise(none))


def near_words(words: DataFrame) -> DataFrame:
    """a, n_a, b, n_b: every pair of words one insertion, deletion or replacement apart, once.

    words: word, n; words of at least four code points, else ValueError at run time.
    """
    short = F.char_length("word") < 4
    checked = words.where(F.when(short, F.raise_error("words have at least four code points").cast("boolean")).otherwise(F.lit(True)))
    rare = materialize(prefixes(checked.select("word")), "rarest")
    alike = rare.select("word", F.explode(meeting_keys(False)).alias("key"))
    longer = rare.select(F.col("word").alias("b"), F.explode(meeting_keys(True)).alias("key"))
    same = alike.select(F.col("word").alias("a"), "key").join(alike.select(F.col("word").alias("b"), "key"), "key").where("a < b")
    other = alike.select(F.col("word").alias("a"), "key").join(longer, "key")
    pairs = materialize(same.unionByName(other).where(F.levenshtein("a", "b", 1) == 1).select("a", "b").distinct(), "pairs")
    counts = lambda c: words.select(F.col("word").alias(c), F.col("n").alias(f"n_{c}"))
    return pairs.join(counts("a"), "a").join(counts("b"), "b").select("a", "n_a", "b", "n_b")


def spelling_groups(words: DataFrame, factor: int = 10) -> DataFrame:
    """word, form, root, n, n_near, form_n. words: word (unique), n.

    A word's form is the most frequent near word (ties: the smallest), if it is `factor` (2 or
    more) times as frequent; its root is where the forms end, which they do after
    log(largest n) steps, halved by each round here.
    """
    if factor < 2:
        raise ValueError("factor is at least 2")
    words = materialize(words, "words")
    pairs = materialize(near_words(words), "near")
    both = pairs.select(F.col("a").alias("word"), "n_a", F.col("b").alias("near"), "n_b").unionByName(pairs.select(F.col("b").alias("word"), F.col("n_b").alias("n_a"), F.col("a").alias("near"), F.col("n_a").alias("n_b")))
    best = F.min(F.struct((-F.col("n_b")).alias("less"), "near")).alias("best")
    near = both.groupBy("word", "n_a").agg(F.count("*").alias("n_near"), best)
    fits = -F.col("best.less") >= factor * F.col("n_a")
    near = materialize(near.select("word", "n_near", F.when(fits, F.col("best.near")).alias("form"), F.when(fits, -F.col("best.less")).alias("form_n")), "forms")
    roots = near.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        next_ = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        roots = materialize(roots.join(next_, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.isnotnull("further").alias("moved")), "roots")
        if roots.where("moved").isEmpty():
            break
        roots = roots.drop("moved")
    return words.join(near, "word", "left").join(roots.drop("moved"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n",
    )


def planted(doc: str | None):
    """Every 31st word of a document, by its hash, loses a code point."""
    begun = zlib.crc32((doc or "").encode() + b":")

    def turn(word: bytes) -> bytes:
        h = zlib.crc32(word, begun)
        if h % 31:
            return word
        chars = word.decode()
        i = h % len(chars)
        return (chars[:i] + chars[i + 1 :]).encode()

    return turn


def op12_spelling_variants(spark, sf_dir: str) -> DataFrame:
    return spelling_groups(word_counts(table(spark, sf_dir, "documents"), change=planted))
