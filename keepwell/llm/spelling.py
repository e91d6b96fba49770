"""Spelling variants: words that differ by one letter, found with bit-sliced position indexes.

An index over some words holds one set of bits for every (position, letter): bit i says that word i has
that letter there. A word is looked up against all of them at once. Walking over its letters, two kinds
of sets are kept side by side: the words that agree so far without an error, and those that agree with
one error, by a replaced letter (same positions) or an additional letter (positions shifted by one).

Two words with one error between them, the shorter of m letters, agree in their first m // 2 letters or in
their last m - m // 2. So words meet in buckets named by m and one of these halves; a word of L letters is
in the buckets of m = L and m = L - 1. Each bucket has its own index, and its words of m letters are
looked up in it. A bucket of more than BLOCK words is cut into blocks, and every block of looked-up words meets
every block of the index, so no task holds more than two blocks whatever a bucket's size.

Defined cases: null and empty texts have no words; without a document id no letter is deleted; letters
are code points; texts of any length are read whole; words of equal count order by code points; repeated
rows count again; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepwell.llm.staging import stage

LETTERS = "A-Za-z\\u00C0-\\u00FF"
LEAST_LETTERS = 6
LEAST_COUNT = 5
# A near word is a word's form if it is so many times as frequent.
DOMINANCE = 5
# One run in so many loses a letter, so that corpora without misspellings have some.
SLIP_EVERY = 199
BLOCK = 1 << 15


class BitSlices:
    """(position, letter) sets over some words, as whole numbers with one bit for each word."""

    def __init__(self, words: list[str]) -> None:
        self.words = words
        self.at: dict[tuple[int, str], int] = {}
        self.of_length: dict[int, int] = {}
        for i, word in enumerate(words):
            bit = 1 << i
            self.of_length[len(word)] = self.of_length.get(len(word), 0) | bit
            for place in enumerate(word):
                self.at[place] = self.at.get(place, 0) | bit

    def near(self, word: str) -> Iterator[str]:
        """Words of the index that come from `word` by replacing or adding exactly one letter."""
        exact = (1 << len(self.words)) - 1
        replaced = added = 0
        for j, letter in enumerate(word):
            same = self.at.get((j, letter), 0)
            added = (added | exact) & self.at.get((j + 1, letter), 0)
            replaced = (replaced & same) | (exact & ~same)
            exact &= same
            if not (exact or replaced or added):
                return
        found = replaced & self.of_length.get(len(word), 0)
        found |= (added | exact) & self.of_length.get(len(word) + 1, 0)
        while found:
            lowest = found & -found
            yield self.words[lowest.bit_length() - 1]
            found ^= lowest


def _slipped(run: Column, ident: Column, every: int) -> Column:
    """The run, without its letter h % length where `every` divides its draw h."""
    h = F.crc32(F.concat(ident.cast("string"), F.lit(":"), run).cast("binary"))
    place = F.pmod(h, F.length(run).cast("long")).cast("int")
    short = F.concat(F.substring(run, F.lit(1), place), F.substring(run, place + 2, F.length(run)))
    return F.when(F.pmod(h, F.lit(every)) == 0, short).otherwise(run)


def vocabulary(
    docs: DataFrame, ident: str = "doc_id", text: str = "text", letters: int = LEAST_LETTERS,
    count: int = LEAST_COUNT, slip_every: int | None = None,
) -> DataFrame:
    """(word, n): runs of letters, A-Z in lower case, of at least so many letters and occurrences.

    Counts are combined before they are shuffled, so a very common word costs one row for each task.
    """
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    folded = F.translate(F.col(text), upper, upper.lower())
    runs = F.regexp_extract_all(folded, F.lit(f"[{LETTERS}]{{{letters},}}"), F.lit(0))
    found = docs.select(F.col(ident).alias("ident"), F.explode(runs).alias("run"))
    word = F.col("run")
    if slip_every:
        word = F.coalesce(_slipped(word, F.col("ident"), slip_every), word)
    kept = found.select(word.alias("word")).filter(F.length("word") >= letters)
    return kept.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= count)


def _buckets(words: DataFrame) -> DataFrame:
    """(bucket, word, n, short): where words meet; short: whether the word is one that is looked up there."""
    size = F.length("word")

    def of(m: Column) -> list[Column]:
        half = F.floor(m / 2).cast("int")
        name = lambda side, part: F.concat(F.lit(side), m.cast("string"), F.lit(":"), part)
        first = F.substring(F.col("word"), F.lit(1), half)
        last = F.substring(F.col("word"), size - (m - half) + 1, m)
        return [
            F.struct(name("<", first).alias("bucket"), (size == m).alias("short")),
            F.struct(name(">", last).alias("bucket"), (size == m).alias("short")),
        ]

    places = F.explode(F.array(*of(size), *of(size - 1)))
    return words.filter(size > 0).select(places.alias("at"), "word", "n").select("at.bucket", "word", "n", "at.short")


def _meetings(buckets: DataFrame, block: int) -> DataFrame:
    """(bucket, x, y, word, n, listed, asked): block x of a bucket's index with block y of its looked-up words."""
    sizes = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("m"), F.count_if("short").alias("s"))
    sizes = sizes.filter("m > 1 and s > 0")  # a bucket of one word, or without one to look up, has no pairs
    blocks = F.ceil(F.col("m") / block).cast("int")
    rows = buckets.join(sizes, "bucket").withColumn("blocks", blocks)
    rows = rows.withColumn("own", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    whole = rows.filter("blocks = 1").select(
        "bucket", F.lit(0).alias("x"), F.lit(0).alias("y"), "word", "n", F.lit(True).alias("listed"), F.col("short").alias("asked")
    )
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    spread = rows.filter("blocks > 1").select("bucket", "own", others, "word", "n", "short")
    listed = spread.select(
        "bucket", F.col("own").alias("x"), F.col("other").alias("y"), "word", "n", F.lit(True).alias("listed"), F.lit(False).alias("asked")
    )
    asked = spread.filter("short").select(
        "bucket", F.col("other").alias("x"), F.col("own").alias("y"), "word", "n", F.lit(False).alias("listed"), F.lit(True).alias("asked")
    )
    return whole.unionByName(listed).unionByName(asked)


PAIR = "word string, near string, near_n long"


def _look_up(bucket: str, listed: dict[str, int], asked: dict[str, int]) -> Iterable[tuple[str, str, int]]:
    """Ordered near pairs of a bucket.

    Two words that agree in both halves' letters meet twice; the bucket of their last letters leaves them
    to that of their first. Words of one length find each other, so only longer partners are turned round.
    """
    if not asked or not listed:
        return
    index = BitSlices(list(listed))
    for word, n in asked.items():
        first = word[: len(word) // 2]
        for other in index.near(word):
            if bucket[0] == ">" and other.startswith(first):
                continue
            yield word, other, listed[other]
            if len(other) > len(word):
                yield other, word, n


def near_pairs(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, near, near_n), in both directions: the distinct (word, n) rows one letter apart."""
    meetings = _meetings(_buckets(words), block)
    ordered = meetings.repartition("bucket", "x", "y").sortWithinPartitions("bucket", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, listed, asked = None, {}, {}
        for batch in batches:
            out: list[tuple[str, str, int]] = []
            for *place, word, n, is_listed, is_asked in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if place != key:
                    if key:
                        out.extend(_look_up(key[0], listed, asked))
                    key, listed, asked = place, {}, {}
                if is_listed:
                    listed[word] = n
                if is_asked:
                    asked[word] = n
            yield told(out)
        if key:
            yield told(list(_look_up(key[0], listed, asked)))

    def told(pairs: list[tuple[str, str, int]]) -> pa.RecordBatch:
        kinds = pa.string(), pa.string(), pa.int64()
        return pa.RecordBatch.from_arrays(
            [pa.array([p[i] for p in pairs], kind) for i, kind in enumerate(kinds)], names=["word", "near", "near_n"]
        )

    return ordered.mapInArrow(run, PAIR)


def variants(words: DataFrame, dominance: int = DOMINANCE, block: int = BLOCK) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every one of the distinct (word, n) rows.

    form: the most frequent near word, if it is dominant; root: where the forms lead to. A form is
    `dominance` times as frequent as its word, so chains are short and a few doublings reach every end.
    """
    if dominance < 2:
        raise ValueError("a form must be more frequent than its word")
    words = stage(words, "vocabulary")
    best = near_pairs(words, block).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best")
    )
    formed = words.join(best, "word", "left")
    dominant = -F.col("best.less") >= F.lit(dominance) * F.col("n")
    formed = stage(
        formed.select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(dominant, F.col("best.near")).alias("form"), F.when(dominant, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    low, high = formed.agg(F.min("n"), F.max("n")).first()
    hops = math.floor(math.log(high / low, dominance) + 1e-9) if high else 0
    ends = formed.filter("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(hops)) if hops > 1 else 0):
        further = ends.select(F.col("word").alias("root"), F.col("root").alias("end"))
        ends = stage(ends.join(further, "root", "left").select("word", F.coalesce("end", "root").alias("root")), "roots")
    return formed.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def variant_report(docs: DataFrame) -> DataFrame:
    """Variants of the whole corpus's words, with one letter deleted in some runs."""
    return variants(vocabulary(docs, slip_every=SLIP_EVERY))
