"""Removal of passages that repeat, by sparse suffix arrays.

Of all suffixes only those at content-selected positions are retained: in every window of PASSAGE words
the GRAM-word sequence with the least hash is its minimiser, so equal windows retain the suffix at the
same place. Retained suffixes that share their first GRAM words with another are extended to both sides,
over all windows whose minimiser they are; the windows are sorted by content, and each is compared with
its neighbour. In a run of equal windows the first, by (id, digest of the text, position), is the original and the
others are repeats. Adjacent repeats join to spans.

So a word is in a span exactly if it lies in a window of PASSAGE words that stands earlier, in this or
another document. Words are compared as they are, white space between them is not.

Defined cases: null, empty and shorter texts have no windows; rows equal in id and text are one
document; null ids come first in the order; texts of any length are read whole; an empty table gives an
empty result; other columns are carried along whatever their names. Windows are compared by 64-bit hashes.
A window that repeats inside its own text is settled there and sent on once, so texts of one phrase over
and over make no crowd.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepwell.llm.staging import carried, is_taken, light, small_batches, stage, taken_slots
from keepwell.llm.words import gram_hashes, mix, power_tables, text_buffer, words_of

PASSAGE = 50
GRAM = 17
# A passage's minimiser is the least of so many GRAM-word sequences.
CHOICES = PASSAGE - GRAM + 1
# Slots (in bits) of the filter that says which retained suffixes have a partner.
PICK_BITS = 27
PLACE_BITS = np.uint64(24)


def _windows(words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """Text number, first word, minimiser's hash and place in `words` of every window of PASSAGE words.

    Hashes are compared by their upper bits; ties go to the leftmost sequence.
    """
    counts = np.maximum(np.diff(at) - PASSAGE + 1, 0)
    texts = np.repeat(np.arange(len(counts)), counts)
    first = np.arange(len(texts)) - np.repeat(np.cumsum(counts) - counts, counts)
    if not len(texts):
        return texts, first, np.zeros(0, np.uint64), texts
    grams = gram_hashes(words, GRAM)
    place = np.arange(len(grams)).astype(np.uint64) & ((np.uint64(1) << PLACE_BITS) - np.uint64(1))
    keys = (grams >> PLACE_BITS << PLACE_BITS) | place
    # least key of CHOICES neighbours by doubling
    least, width = keys, 1
    while 2 * width <= CHOICES:
        least = np.minimum(least[: len(least) - width], least[width:])
        width *= 2
    rest = CHOICES - width
    least = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
    starts = at[texts] + first
    chosen = least[starts]
    # the place's upper part is the window's own or, past a multiple of 2**PLACE_BITS, the next
    low = (chosen & ((np.uint64(1) << PLACE_BITS) - np.uint64(1))).astype(np.int64)
    place_of = starts + ((low - starts) & ((1 << int(PLACE_BITS)) - 1))
    return texts, first, grams[place_of], place_of


def _passage_hashes(words: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Hash of the PASSAGE words from each start."""
    powers, inverse = power_tables(len(words) + 1)
    sums = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(words * powers[: len(words)], out=sums[1:])
    return mix((sums[starts + PASSAGE] - sums[starts]) * inverse[starts])


def _suffixes(docs: DataFrame) -> DataFrame:
    """(h): hash of the first GRAM words of every retained suffix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, _, _, at = words_of(*text_buffer(batch.column(0)), fold_case=False)
            texts, _, chosen, place = _windows(words, at)
            new = np.ones(len(texts), dtype=bool)  # one suffix serves a run of windows
            new[1:] = (texts[1:] != texts[:-1]) | (place[1:] != place[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(chosen[new].view(np.int64))], names=["h"])

    return docs.select("text").mapInArrow(run, "h long")


def _passages(docs: DataFrame, picked) -> DataFrame:
    """(h, doc, kw): the windows of retained suffixes that may have a partner, each once for its text.

    kw: a digest of the text above, the first word's number below.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = picked.value
        for batch in batches:
            words, _, _, at = words_of(*text_buffer(batch.column(2)), fold_case=False)
            texts, first, chosen, _ = _windows(words, at)
            hit = is_taken(wanted, (chosen >> np.uint64(64 - PICK_BITS)).astype(np.int64))
            texts, first = texts[hit], first[hit]
            hashes = _passage_hashes(words, at[texts] + first)
            order, new = _sorted_windows(texts, hashes)
            order = np.sort(order[new])
            texts, first, hashes = texts[order], first[order], hashes[order]
            kw = (batch.column(1).to_numpy()[texts] << np.int64(32)) | first
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes.view(np.int64)), batch.column(0).take(pa.array(texts)), pa.array(kw)],
                names=["h", "doc", "kw"],
            )

    return docs.select("doc", "k", "text").mapInArrow(run, "h long, doc long, kw long")


def _sorted_windows(texts: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the windows by text and content, and where in it a new content begins."""
    order = np.lexsort((hashes, texts))  # stable: equal windows stay in the order of their places
    new = np.ones(len(order), dtype=bool)
    new[1:] = (texts[order[1:]] != texts[order[:-1]]) | (hashes[order[1:]] != hashes[order[:-1]])
    return order, new


def _own_spans(docs: DataFrame) -> DataFrame:
    """Spans that repeat an earlier place of the same text, found inside the text; the place before is the original."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, _, _, at = words_of(*text_buffer(batch.column(2)), fold_case=False)
            texts, first, _, _ = _windows(words, at)
            order, new = _sorted_windows(texts, _passage_hashes(words, at[texts] + first))
            again = np.flatnonzero(~new)
            here, back = order[again], first[order[again]] - first[order[again - 1]]
            by_place = np.argsort(here, kind="stable")
            here, back = here[by_place], back[by_place]
            begin = np.ones(len(here), dtype=bool)
            begin[1:] = (here[1:] != here[:-1] + 1) | (back[1:] != back[:-1]) | (texts[here[1:]] != texts[here[:-1]])
            a = np.flatnonzero(begin)
            z = np.append(a[1:], len(here))[: len(a)] - 1
            doc = batch.column(0).take(pa.array(texts[here[a]]))
            start = first[here[a]]
            yield pa.RecordBatch.from_arrays(
                [doc, batch.column(1).take(pa.array(texts[here[a]])), pa.array(start, pa.int32()),
                 pa.array(first[here[z]] + PASSAGE, pa.int32()), doc, pa.array(start - back[a], pa.int32())],
                names=SPAN_NAMES,
            )

    return docs.select("doc", "k", "text").mapInArrow(run, SPAN)


def _repeats(passages: DataFrame) -> DataFrame:
    """(doc, k, w, first_doc, first_w) of every window that stands earlier: neighbours in sorted order are compared."""
    order = passages.repartition("h").sortWithinPartitions("h", "doc", "kw")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the original of the run at the end of the batch before
        for batch in batches:
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            h, doc, kw = batch.column(0).to_numpy(), batch.column(1), batch.column(2)
            new = np.ones(len(h), dtype=bool)
            new[1:] = h[1:] != h[:-1]
            original = np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))
            values = doc.fill_null(0).to_numpy(), doc.is_null().to_numpy(zero_copy_only=False), kw.to_numpy()
            # equal rows are one document, so their windows are one window
            repeat = np.flatnonzero(~np.logical_and.reduce([x[original] == x for x in values]))
            if len(repeat):
                of = pa.array(original[repeat])
                repeat = pa.array(repeat)
                yield pa.RecordBatch.from_arrays(
                    [doc.take(repeat), kw.take(repeat), doc.take(of), kw.take(of)],
                    names=["doc", "kw", "first_doc", "first_kw"],
                )
            held = batch.slice(int(original[-1]), 1) if len(h) else None

    word = lambda c: F.col(c).bitwiseAND(F.lit((1 << 32) - 1)).cast("int")
    return order.mapInArrow(run, "doc long, kw long, first_doc long, first_kw long").select(
        "doc", F.shiftright("kw", 32).alias("k"), word("kw").alias("w"), "first_doc", word("first_kw").alias("first_w")
    )


def _spans(repeats: DataFrame) -> DataFrame:
    """(doc, k, start, stop, first_doc, first_start): adjacent windows with adjacent originals joined, in words."""
    order = repeats.repartition("doc", "k").sortWithinPartitions("doc", "k", "w", "first_doc", "first_w")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the span still open
        for batch in batches:
            doc, k, w, first_doc, first_w = (batch.column(i) for i in range(5))
            keys = [doc.fill_null(0).to_numpy(), doc.is_null().to_numpy(zero_copy_only=False), k.to_numpy(),
                    first_doc.fill_null(0).to_numpy(), first_doc.is_null().to_numpy(zero_copy_only=False)]
            w, first_w = w.to_numpy(), first_w.to_numpy()
            new = np.ones(len(w), dtype=bool)
            same = np.logical_and.reduce([x[1:] == x[:-1] for x in keys])
            near = (w[1:] - w[:-1] <= 1) & ((first_w[1:] - w[1:] == first_w[:-1] - w[:-1]) | (w[1:] == w[:-1]))
            new[1:] = ~(same & near)
            at = np.flatnonzero(new)
            ends = np.append(at[1:], len(w)) - 1
            rows = [
                [doc[int(a)].as_py(), k[int(a)].as_py(), int(w[a]), int(w[e]) + PASSAGE, first_doc[int(a)].as_py(), int(first_w[a])]
                for a, e in zip(at, ends, strict=True)
            ]
            if last and rows and _goes_on(last, rows[0]):
                rows[0] = [*last[:3], rows[0][3], *last[4:]]
            elif last:
                rows.insert(0, last)
            last = rows.pop() if rows else last
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate(SPAN_TYPES)], names=SPAN_NAMES
            )
        if last:
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(last, SPAN_TYPES, strict=True)], names=SPAN_NAMES)

    return order.mapInArrow(run, SPAN)


SPAN = "doc long, k long, start int, stop int, first_doc long, first_start int"
SPAN_NAMES = ["doc", "k", "start", "stop", "first_doc", "first_start"]
SPAN_TYPES = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32())


def _goes_on(span: list, other: list) -> bool:
    """Whether another span's first window follows the last one of a span."""
    return (
        [span[0], span[1], span[4]] == [other[0], other[1], other[4]]
        and other[2] == span[3] - PASSAGE + 1
        and other[5] - other[2] == span[5] - span[2]
    )


def repeated_spans(docs: DataFrame) -> DataFrame:
    """Spans of (doc, k, text) rows that repeat earlier ones: see _spans."""
    small_batches(docs.sparkSession)
    partners = _suffixes(docs).groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    picked = docs.sparkSession.sparkContext.broadcast(taken_slots(partners, "h", PICK_BITS))
    found = _spans(_repeats(_passages(docs, picked))).unionByName(_own_spans(docs))
    return found.distinct()  # equal rows of one document tell the same


def _digest(text: Column) -> Column:
    """31 bits that tell texts of one id apart."""
    return F.shiftrightunsigned(F.xxhash64(text), 33)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc"), _digest(F.col("text")).alias("k"), "text")


def repeat_report(docs: DataFrame) -> DataFrame:
    """One row for each span that repeats: where it is, and where its original begins."""
    return repeated_spans(_keyed(docs)).select(
        F.col("doc").alias("doc_id"), F.col("start").alias("word_start"), (F.col("stop") - F.col("start")).alias("n_words"),
        F.col("first_doc").alias("first_doc_id"), F.col("first_start").alias("first_word_start"),
    )


def _cut(text: str, spans: list[tuple[int, int]]) -> str:
    """text without the words of the spans and the white space after them."""
    raw = text.encode()
    column = pa.array([text], pa.large_string())
    _, starts, _, _ = words_of(*text_buffer(column), fold_case=False)
    edges = np.append(starts, len(raw))
    kept, at = [], 0
    for start, stop in sorted(spans):
        if edges[start] > at:
            kept.append(raw[at : edges[start]])
        at = max(at, int(edges[stop]))
    return b"".join([*kept, raw[at:]]).decode()


def without_repeats(docs: DataFrame) -> DataFrame:
    """docs with repeated spans cut out of the texts; documents of which no word is left go."""
    spans = repeated_spans(_keyed(docs))
    cuts = spans.groupBy("doc", "k").agg(
        F.collect_set(F.struct("start", "stop")).alias("_spans")  # at most one for each word of the text
    )
    cuts = light(stage(cuts, "cuts"))
    rows = carried(docs, ident=F.col("doc_id").cast("long"), digest=_digest(F.col("text")))
    joined = rows.join(cuts, F.col("ident").eqNullSafe(F.col("doc")) & (F.col("digest") == F.col("k")), "left")

    @F.pandas_udf("string")
    def cut(texts, all_spans):
        return texts.combine(all_spans, lambda t, s: _cut(t, [(x["start"], x["stop"]) for x in s]))

    touched = joined.filter("_spans is not null").withColumn("text", cut("row.text", "_spans"))
    left = touched.filter(F.col("text").rlike("[^ \\t-\\r]")).select(F.col("row").withField("text", F.col("text")).alias("row"))
    return joined.filter("_spans is null").select("row").unionByName(left).select("row.*")
