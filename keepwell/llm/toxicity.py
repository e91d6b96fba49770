"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are its distinct words, word pairs, triples and pairs with one or two words
between, hashed into 2**BITS slots. Training runs in rounds: every one of SHARDS shards starts from
the same state (z and n per slot) and updates it per coordinate, document by document; the shards' states
are averaged slot by slot. L1 leaves most slots at weight zero; what is left is one
float per slot, of a size that BITS fixes, and goes to the scoring tasks by broadcast.

Training uses at most SAMPLE labelled rows (those with the smallest hash of doc_id); scoring reads
every text whole.

Defined cases: a null or empty text has the intercept's score; labels that are null or not 0 or 1 and
labels without a document are not learned from; of several labels of one id each is learned from;
without any training row every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepwell.llm.staging import small_batches, stage
from keepwell.llm.words import FACTORS, mix, text_buffer, words_of
from keepwell.session import fresh_path

BITS = 20
SAMPLE = 24_000
SHARDS = 4
# Rows that hold a shard's documents: a task trains on one after the other.
PIECES = 32
# Slots of a shard's state that travel in one row.
STATE_SLOTS = 1 << 15
ROUNDS = 8
ALPHA, BETA, L1, L2 = 3.0, 1.0, 3.0, 0.0
HELD_OUT_OF = 5


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT_OF == 0, F.lit(False))


def _features(words: np.ndarray) -> np.ndarray:
    """Slots of the features of one text's word hashes, with repeats."""
    parts = [words]
    for gaps in ((1,), (2,), (3,), (1, 2)):
        n = len(words) - gaps[-1]
        if n > 0:
            total = words[:n] * FACTORS[0]
            for k, gap in enumerate(gaps):
                total = total + words[gap : gap + n] * FACTORS[8 * len(gaps) + 2 * gap + k]
            parts.append(mix(total))
    return (np.concatenate(parts) >> np.uint64(64 - BITS)).astype(np.int32)


def _texts(column: pa.Array) -> Iterator[np.ndarray]:
    data, offsets = text_buffer(column)
    hashes, _, _, at = words_of(data, offsets, fold_case=True)
    for a, b in zip(at[:-1], at[1:], strict=True):
        yield hashes[a:b]


def _weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    small = np.abs(z) <= L1
    return np.where(small, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def _train(z: np.ndarray, n: np.ndarray, slots: np.ndarray, label: float) -> None:
    """One FTRL-proximal step over the distinct features of a text."""
    own_z, own_n = z[slots], n[slots]
    w = _weights(own_z, own_n)
    p = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35)))
    g = p - label
    more = own_n + g * g
    z[slots] = own_z + g - (np.sqrt(more) - np.sqrt(own_n)) / ALPHA * w
    n[slots] = more


INTERCEPT = 0


def _pack(pdf: pd.DataFrame) -> pd.DataFrame:
    """A piece's documents as one row: all slots end to end, with lengths, labels and the documents' own draws."""
    pdf = pdf.sort_values(["drawn", "label"], kind="stable")
    return pd.DataFrame(
        {
            "shard": pdf["shard"].iloc[:1],
            "piece": pdf["piece"].iloc[:1],
            "slots": [b"".join(pdf["slots"])],
            "lengths": [(pdf["slots"].str.len() // 4).to_numpy("<i4").tobytes()],
            "labels": [pdf["label"].to_numpy("<f8").tobytes()],
        }
    )


PACKED = "piece int, slots binary, lengths binary, labels binary, shard int"


def _round(start, round_: int):
    """The function that trains one shard from the broadcast state, with an order in each piece drawn for the round."""

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
        at, z_at, n_at = start.value
        z[at], n[at] = z_at, n_at
        trained = False
        for batch in batches:
            for piece, slots, lengths, labels in zip(*(batch.column(k) for k in range(4)), strict=True):
                slots, labels = np.frombuffer(slots.as_buffer(), "<i4"), np.frombuffer(labels.as_buffer())
                ends = np.cumsum(np.frombuffer(lengths.as_buffer(), "<i4"))
                for i in np.random.RandomState([round_, piece.as_py()]).permutation(len(ends)):
                    _train(z, n, slots[ends[i - 1] if i else 0 : ends[i]], labels[i])
                trained = True
        if trained:
            used = np.flatnonzero(n)
            for at in np.array_split(used, -(-len(used) // STATE_SLOTS)):
                state = at.astype("<i4"), z[at].astype("<f4"), n[at].astype("<f4")
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array([x.tobytes()], pa.binary()) for x in state), pa.array([bool(at[0] == used[0])])],
                    names=["slots", "z", "n", "first"],
                )

    return learn


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, rounds: int = ROUNDS) -> np.ndarray:
    """Weights per slot, learned from the labelled documents that are not held out."""
    spark = docs.sparkSession
    small_batches(spark)
    usable = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = (
        usable.select("doc_id", F.col("toxic").cast("double").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample)
    )
    # at most `sample` rows of an id and a number
    chosen = stage(chosen, "labelled")

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots = [np.unique(np.append(_features(w), INTERCEPT)).astype("<i4").tobytes() for w in _texts(batch.column(2))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(slots, pa.binary())], names=["doc_id", "label", "slots"]
            )

    joined = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text")
    drawn = F.xxhash64(F.lit(7), "doc_id")
    rows = joined.mapInArrow(featurise, "doc_id long, label double, slots binary").select(
        drawn.alias("drawn"), F.pmod(drawn, F.lit(SHARDS)).cast("int").alias("shard"),
        F.pmod(F.shiftright(drawn, 8), F.lit(PIECES)).cast("int").alias("piece"), "label", "slots",
    )
    # SAMPLE / SHARDS / PIECES documents a row, moved once; a round reads a shard's rows without a shuffle
    path = fresh_path(spark, "shards")
    rows.groupBy("shard", "piece").applyInPandas(_pack, PACKED).write.partitionBy("shard").parquet(path)
    pieces = spark.read.schema(PACKED).parquet(path)
    # a union keeps a task for each shard instead of joining them into one
    spark.conf.set("spark.sql.unionOutputPartitioning", "false")
    shards = [pieces.filter(F.col("shard") == k).drop("shard").coalesce(1) for k in range(SHARDS)]

    z, n = np.zeros(1 << BITS, np.float32), np.zeros(1 << BITS, np.float32)
    for round_ in range(rounds):
        start = spark.sparkContext.broadcast(
            (np.flatnonzero(n).astype("<i4"), z[n > 0], n[n > 0])
        )
        learn = _round(start, round_)
        states = [shard.mapInArrow(learn, "slots binary, z binary, n binary, first boolean") for shard in shards]
        z_sum, n_sum, seen = np.zeros(1 << BITS), np.zeros(1 << BITS), 0
        # SHARDS states of at most 12 * 2**BITS bytes, one at a time
        for state in reduce(DataFrame.unionAll, states).toLocalIterator():
            at = np.frombuffer(state["slots"], dtype="<i4")
            z_sum[at] += np.frombuffer(state["z"], dtype="<f4")
            n_sum[at] += np.frombuffer(state["n"], dtype="<f4")
            seen += state["first"]
        z, n = (z_sum / max(seen, 1)).astype(np.float32), (n_sum / max(seen, 1)).astype(np.float32)
        start.destroy()
    return _weights(z, n).astype(np.float32)


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """docs' doc_id with `score`; one pass over the whole texts."""
    spark = docs.sparkSession
    small_batches(spark)
    at = np.flatnonzero(weights)
    sent = spark.sparkContext.broadcast((at, weights[at]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << BITS, dtype=np.float32)
        at, values = sent.value
        table[at] = values
        for batch in batches:
            scores = np.empty(batch.num_rows)
            for i, words in enumerate(_texts(batch.column(1))):
                slots = np.unique(np.append(_features(words), INTERCEPT))
                scores[i] = table[slots].sum(dtype=np.float64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(1.0 / (1.0 + np.exp(-np.clip(scores, -35, 35))))], names=["doc_id", "score"]
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: whether it is held out, its score and the predicted label."""
    scored = score(docs, train(docs, labels))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
