"""Benchmark decontamination with a positional inverted index of the training text.

build_index stores, for blocks of about BLOCK_WORDS training words, one row per term with the rising positions at
which it stands; rows of a block's own describe its documents. A term is the 64-bit hash of a word, A-Z in lower case.
Positions count through a block, with GAP empty places between two documents, so no match crosses a border.

A phrase is looked up with its terms' lists alone: the index is joined with the terms of the benchmark, so
other lists are not read on, and the lists of a block come together. In a block, the rarest term of each phrase proposes
starts (its positions less its offset); the next rarer lists, shifted by their offsets, are intersected
with them one after the other. That gives exact matches. With a tolerance, a term may stand up to `slop` places
from where it belongs: proximity matches.

Benchmark phrases travel to the blocks in slices of at most SLICE_WORDS words, so what is broadcast is
bounded; a larger benchmark takes more slices over the stored index, and results are joined.

Defined cases: null, empty and wordless texts hold no words, match nothing and are no phrases; an item
shorter than a window is one window; rows of documents stand for themselves, also with equal or null ids;
repeated items name one item id once; a null item id takes part in hits and is not named; texts of any length are
read whole (a block holds at least one document); empty tables give no matches, and no rows for no documents; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepwell.llm.staging import small_batches, stage
from keepwell.llm.words import text_buffer, words_of

WINDOW = 10
# Places that a near match's terms may be away from where they belong.
SLOP = 2
BLOCK_WORDS = 1 << 21
SLICE_WORDS = 1 << 20
GAP = 64
# Bytes that stand in no word: all of ASCII but digits and a-z (A-Z count as a-z).
SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[:128] = True
SEPARATOR[ord("0") : ord("9") + 1] = SEPARATOR[ord("a") : ord("z") + 1] = SEPARATOR[ord("A") : ord("Z") + 1] = False

INDEX = "block long, term long, n int, positions binary, idents array<long>, sizes array<int>"


def terms_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Term hashes of all texts, and the n + 1 word offsets of the texts."""
    data, offsets = text_buffer(column)
    words, _, _, at = words_of(data, offsets, fold_case=True, white=SEPARATOR)
    return words.view(np.int64), at


def _block_starts(sizes: np.ndarray) -> np.ndarray:
    """First position of each document of a block, and the end."""
    return np.concatenate([[0], np.cumsum(sizes.astype(np.int64) + GAP)])


def build_index(docs: DataFrame, ident: str = "doc_id", text: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """The stored index: for every block a row per term, and one without a term for its documents."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[tuple[np.ndarray, np.ndarray, list]] = []
        size = 0
        for batch in batches:
            words, at = terms_of(batch.column(1))
            held.append((words, np.diff(at), batch.column(0).to_pylist()))
            size += len(words)
            if size >= block_words:
                yield from packed(number, held)
                number, held, size = number + 1, [], 0
        if held:
            yield from packed(number, held)

    def packed(number: int, held: list[tuple[np.ndarray, np.ndarray, list]]) -> Iterator[pa.RecordBatch]:
        words = np.concatenate([h[0] for h in held])
        sizes = np.concatenate([h[1] for h in held])
        idents = [i for h in held for i in h[2]]
        starts = _block_starts(sizes)
        positions = np.arange(len(words)) + np.repeat(starts[:-1] - (np.cumsum(sizes) - sizes), sizes)
        order = np.argsort(words, kind="stable")
        words, positions = words[order], positions[order].astype("<u4")
        first = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]])) if len(words) else np.zeros(0, np.int64)
        edges = np.append(first, len(words))
        lists = pa.Array.from_buffers(
            pa.large_binary(), len(first), [None, pa.py_buffer((edges * 4).astype(np.int64)), pa.py_buffer(positions)]
        )
        none = pa.nulls(len(first), pa.list_(pa.int64())), pa.nulls(len(first), pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(first), number)), pa.array(words[first]), pa.array(np.diff(edges).astype(np.int32)),
             lists.cast(pa.binary()), *none], names=names,
        )
        yield pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), pa.nulls(1, pa.int64()), pa.array([len(sizes)], pa.int32()), pa.nulls(1, pa.binary()),
             pa.array([idents], pa.list_(pa.int64())), pa.array([sizes.astype(np.int32)], pa.list_(pa.int32()))], names=names,
        )

    names = [part.split()[0] for part in INDEX.split(", ")]
    rows = docs.select(F.col(ident).cast("long").alias("ident"), F.col(text).alias("text"))
    return stage(rows.mapInArrow(run, INDEX), "index")


class Phrases(NamedTuple):
    """Windows of the items of a slice."""

    terms: np.ndarray  # a row of `window` terms for each, zeros behind short ones
    sizes: np.ndarray  # terms of each
    item: np.ndarray  # place of its item id in `items`, -1 without one
    items: np.ndarray


def phrases_of(idents: list[int | None], terms: list[np.ndarray], window: int) -> Phrases:
    shapes = [np.lib.stride_tricks.sliding_window_view(t, min(window, len(t))) for t in terms]
    sizes = np.concatenate([np.full(len(s), s.shape[1]) for s in shapes])
    rows = np.zeros((len(sizes), window), dtype=np.int64)
    at = 0
    for shape in shapes:
        rows[at : at + len(shape), : shape.shape[1]] = shape
        at += len(shape)
    known = sorted({i for i in idents if i is not None})
    number = {ident: k for k, ident in enumerate(known)}
    item = np.repeat([number.get(i, -1) for i in idents], [len(s) for s in shapes])
    return Phrases(rows, sizes, item, np.array(known, dtype=np.int64))


def matches(phrases: Phrases, terms: np.ndarray, counts: np.ndarray, positions: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray]:
    """(phrase, start) of every match in a block.

    terms rise and counts are their lists' lengths; positions: the lists, one after the other. A match at a
    start has every term k within `slop` places of start + k.
    """
    window = phrases.terms.shape[1]
    place = np.searchsorted(terms, phrases.terms)
    place = np.minimum(place, max(len(terms) - 1, 0))
    real = np.arange(window) < phrases.sizes[:, None]
    found = (terms[place] == phrases.terms) if len(terms) else np.zeros(place.shape, dtype=bool)
    whole = np.flatnonzero((found | ~real).all(axis=1))  # the others lack a term in this block
    place, real, sizes = place[whole], real[whole], phrases.sizes[whole]
    if not len(whole):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    lengths = np.where(real, counts[place], np.iinfo(np.int64).max)
    rarest_first = np.argsort(lengths, axis=1, kind="stable")
    ends = np.cumsum(counts)
    # the rarest list proposes the starts
    offset = rarest_first[:, 0]
    of = place[np.arange(len(whole)), offset]
    n = counts[of]
    who = np.repeat(np.arange(len(whole)), n)
    at = np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(ends[of] - n, n)
    starts = positions[at] - np.repeat(offset, n)
    if slop:
        spread = np.arange(-slop, slop + 1)
        starts = (starts[:, None] + spread).ravel()
        who = np.repeat(who, len(spread))
        both = np.unique(np.stack([who, starts]), axis=1)
        who, starts = both[0], both[1]
    # (list, position) as one rising number, so one search serves all lists
    width = np.int64(int(positions.max()) + 4 * GAP)
    keys = np.repeat(np.arange(len(terms)), counts) * width + positions + GAP
    for k in range(1, window):
        offset = rarest_first[who, k]
        more = sizes[who] > k
        wanted = place[who, offset] * width + starts + offset + GAP
        near = np.searchsorted(keys, wanted - slop)
        hit = keys[np.minimum(near, len(keys) - 1)]
        held = ~more | ((near < len(keys)) & (hit <= wanted + slop))
        who, starts = who[held], starts[held]
    return whole[who], starts


FOUND = "block long, ordinal int, spans array<struct<start:long,stop:long>>, items array<long>, near_items array<long>"


def _covered(starts: np.ndarray, stops: np.ndarray) -> list[dict]:
    """The union of spans that come sorted by start, as disjoint spans."""
    reach = np.maximum.accumulate(stops)
    new = np.ones(len(starts), dtype=bool)
    new[1:] = starts[1:] > reach[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    return [{"start": int(a), "stop": int(z)} for a, z in zip(starts[first], reach[last], strict=True)]


def _search_block(pdf: pd.DataFrame, phrases: Phrases, slop: int) -> pd.DataFrame:
    """The matches of a slice in the lists of a block, one row for each document that has any."""
    own = pdf["sizes"].notna()
    columns = ["block", "ordinal", "spans", "items", "near_items"]
    lists = pdf[~own].sort_values("term")
    if lists.empty:
        return pd.DataFrame(columns=columns)
    sizes = np.asarray(pdf[own]["sizes"].iloc[0])
    starts_of = _block_starts(sizes)
    terms = lists["term"].to_numpy(np.int64)
    counts = lists["n"].to_numpy(np.int64)
    positions = np.frombuffer(b"".join(lists["positions"]), dtype="<u4").astype(np.int64)
    exact, at = matches(phrases, terms, counts, positions, 0)
    near, near_at = matches(phrases, terms, counts, positions, slop) if slop else (exact, at)
    # a near match's start may lie before its text; its rarest term does not, so the end tells the text
    doc = np.searchsorted(starts_of, at, side="right") - 1
    near_doc = np.searchsorted(starts_of, np.maximum(near_at + slop, 0), side="right") - 1
    rows: dict[int, tuple[list, set, set]] = {}
    order = np.lexsort((at, doc))
    exact, at, doc = exact[order], at[order], doc[order]
    for d in np.unique(near_doc):
        rows[int(d)] = ([], set(), set())
    edges = np.searchsorted(doc, [*np.unique(doc), np.iinfo(np.int64).max])
    for a, z in zip(edges[:-1], edges[1:], strict=True):
        begin = at[a:z] - starts_of[doc[a]]
        which = np.unique(phrases.item[exact[a:z]])
        rows[int(doc[a])] = (_covered(begin, begin + phrases.sizes[exact[a:z]]), set(which.tolist()) - {-1}, set())
    both = np.unique(np.stack([near_doc, phrases.item[near]]), axis=1)
    for d, i in both.T.tolist():
        if i >= 0:
            rows[d][2].add(i)
    named = lambda found: [int(phrases.items[i]) for i in sorted(found)]
    block = int(pdf["block"].iloc[0])
    return pd.DataFrame([(block, d, s, named(i), named(j)) for d, (s, i, j) in rows.items()], columns=columns)


def _searcher(sent: Broadcast, slop: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    return lambda pdf: _search_block(pdf, Phrases(*sent.value), slop)


def _slices(benchmark: DataFrame, ident: str, text: str, window: int, slice_words: int) -> tuple[DataFrame, int]:
    """(slice, item, terms) and the number of slices: the items' words, about slice_words of them in a slice.

    Longer items are cut, with a window's overlap.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(slice_words - window + 1, 1)
        for batch in batches:
            words, at = terms_of(batch.column(1))
            items, pieces = [], []
            for i, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
                for lo in range(a, max(b - window + 1, a + (b > a)), step):
                    items.append(i)
                    pieces.append(words[lo : min(lo + step + window - 1, b)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(items, pa.int64())), pa.array([p.tobytes() for p in pieces], pa.binary())],
                names=["item", "terms"],
            )

    rows = benchmark.select(F.col(ident).cast("long").alias("item"), F.col(text).alias("text"))
    pieces = stage(rows.mapInArrow(cut, "item long, terms binary"), "items")
    total = pieces.agg(F.sum(F.length("terms"))).first()[0] or 0
    n = max(1, -(-total // (8 * slice_words)))
    return stage(pieces.withColumn("slice", F.pmod(F.xxhash64("item", "terms"), F.lit(n)).cast("int")), "slices"), n


def phrase_matches(
    index: DataFrame, benchmark: DataFrame, ident: str = "item_id", text: str = "text", window: int = WINDOW,
    slop: int = SLOP, slice_words: int = SLICE_WORDS,
) -> DataFrame:
    """(block, ordinal, spans, items, near_items) of the index's documents that match anything.

    spans: disjoint word ranges inside occurrences of a window; items: ids with an occurring window; near_items:
    those with one whose words all stand within `slop` places of their place for some start.
    """
    if window + 2 * slop >= GAP:
        raise ValueError("windows must be shorter than the gap between documents")
    spark = index.sparkSession
    slices, n = _slices(benchmark, ident, text, window, slice_words)
    found = None
    for k in range(n):
        part = slices.filter(F.col("slice") == k)
        rows = part.select("item", "terms").collect()  # about slice_words words
        if not rows:
            continue
        phrases = phrases_of([r.item for r in rows], [np.frombuffer(r.terms, np.int64) for r in rows], window)
        sent = spark.sparkContext.broadcast(tuple(phrases))
        terms = np.unique(phrases.terms[np.arange(window) < phrases.sizes[:, None]])
        wanted = spark.createDataFrame(pd.DataFrame({"term": terms}))
        # no more terms than a slice has words, so the index itself stays where it is
        lists = index.join(F.broadcast(wanted), "term", "left_semi").unionByName(index.filter("term is null"))
        # no nulls among the terms: pandas would round 64-bit numbers beside them
        lists = lists.select("block", F.coalesce("term", F.lit(0).cast("long")).alias("term"), "n", "positions", "sizes")
        hits = lists.groupBy("block").applyInPandas(_searcher(sent, slop), FOUND)
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        return spark.createDataFrame([], FOUND)
    if n == 1:
        return found
    merged = found.groupBy("block", "ordinal").agg(
        F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("near_items")))).alias("near_items"),
    )
    return merged.withColumn("spans", _union_of("spans"))


def _union_of(spans: str):
    """Disjoint spans that cover the same words."""
    open_ = F.array().cast("array<struct<start:long,stop:long>>")

    def add(done, span):
        last = F.element_at(done, -1)
        grown = F.struct(last["start"].alias("start"), F.greatest(last["stop"], span["stop"]).alias("stop"))
        joins = (F.size(done) > 0) & (span["start"] <= F.try_element_at(done, F.lit(-1))["stop"])
        return F.when(joins, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(grown))).otherwise(F.concat(done, F.array(span)))

    return F.aggregate(F.array_sort(spans), open_, add)


def documents_of(index: DataFrame) -> DataFrame:
    """(block, ordinal, doc_id, n_words) of every document of the index."""
    own = index.filter("term is null").select("block", F.posexplode(F.arrays_zip("idents", "sizes")).alias("ordinal", "d"))
    return own.select("block", "ordinal", F.col("d.idents").alias("doc_id"), F.col("d.sizes").cast("long").alias("n_words"))


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: its words, those inside benchmark windows, and which items they come from."""
    index = build_index(docs)
    hits = phrase_matches(index, benchmark)
    spans = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    named = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    digest = F.sha2(F.concat_ws(",", F.coalesce(named, F.array().cast("array<string>"))), 256)
    n_hit = F.coalesce(spans, F.lit(0).cast("long"))
    return documents_of(index).join(hits, ["block", "ordinal"], "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        digest.alias("items_sha256"), (n_hit > 0).alias("contaminated"),
        F.coalesce(F.size("near_items"), F.lit(0)).cast("long").alias("n_near_items"),
    )
