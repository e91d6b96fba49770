"""Exact top-k by inner product: Fagin's threshold algorithm over sorted per-dimension lists.

Vectors are dealt into blocks of about BLOCK rows. A block is stored with one list for every dimension, its rows
in the order of that component, sorted once. A query reads all lists in parallel from the end that its own
component's sign prefers, down to one depth, and scores the rows it meets there. No row it has not met can score
more than the bound, the sum over the dimensions of the product at that depth; once the bound is below its kth
score the query is done with the block. Lists whose products hardly vary are not read: they would add rows and
lower the bound by next to nothing, so their best product stays in it. A query takes its kth score along from block to block. As that score only
rises, a bound already below it says beforehand how deep the lists need to be read at most; where the lists down to
that depth hold most of the block, all of it is scored in one matrix product with the other such queries.

Work is queries times blocks, as an exact search against all rows needs. A task holds a group of blocks and
lets batches of queries pass by, so a block travels once for each lane of batches, a batch once for each group.

How much the bound saves depends on the vectors. Where a few components carry most of the score, a small part
of the rows is met; where all components matter alike, as with random directions, the lists must be read
so deep that nearly every row is met before the bound falls below the kth score (figures in the README).

Defined cases: a vector that is null, or holds a null or a non-finite component, and a row without an id
take no part; shorter vectors count as filled up with zeros; rows with the query's id are the query's
own and no candidates; repeated ids among the queries or candidates are rows of their own; ties go to
the smaller id; with fewer candidates than k all are returned; an empty table gives an empty result; other
columns are not looked at. Components must stay below 2**31 after scaling and scores below 2**53.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from keepwell.llm.staging import small_batches, stage

K = 20
QUERY_EVERY = 20
SCALE = 64
BLOCK = 4096
BATCH = 256
# Blocks that one task holds.
GROUP = 32
# The depth at which the bound is first looked at, and the factor from one look to the next.
DEPTH, DEEPER = 16, 4
# Lists that make up so much of the whole range of products are read.
READ_SHARE = 0.9


def quantised(vectors: DataFrame, ident: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, v): floor(SCALE * component) of the vectors that take part, as whole numbers."""
    parts = F.transform(vector, lambda x: x.cast("double"))
    fine = F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.filter(F.col(ident).isNotNull() & F.col(vector).isNotNull()).filter(F.coalesce(fine, F.lit(False))).select(
        F.col(ident).cast("long").alias("id"), F.transform(parts, lambda x: F.floor(x * SCALE).cast("long")).alias("v")
    )


class SortedLists:
    """The rows of a block and, per dimension, their order by component."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, order: np.ndarray) -> None:
        self.ids, self.rows, self.order = ids, rows.astype(np.float64), order
        n = len(ids)
        self.depths = np.unique(np.minimum(DEPTH * DEEPER ** np.arange(24), n))
        # the components at those depths, from the large and from the small end
        places = np.arange(rows.shape[1])
        self.high = self.rows[order[n - self.depths], places]
        self.low = self.rows[order[self.depths - 1], places]
        self.top, self.bottom = self.rows[order[n - 1], places], self.rows[order[0], places]
        self.scored = 0

    def read_lists(self, queries: np.ndarray) -> np.ndarray:
        """(query, dimension): the lists that a query reads, the fewest that make up READ_SHARE of its products' range."""
        ranges = np.abs(queries) * (self.top - self.bottom)
        order = np.argsort(-ranges, axis=1, kind="stable")
        sums = np.cumsum(np.take_along_axis(ranges, order, axis=1), axis=1)
        chosen = np.zeros(queries.shape, dtype=bool)
        before = np.concatenate([np.zeros((len(queries), 1)), sums[:, :-1]], axis=1)
        np.put_along_axis(chosen, order, before < READ_SHARE * sums[:, -1:], axis=1)
        return chosen

    def bounds(self, queries: np.ndarray, read: np.ndarray) -> np.ndarray:
        """(query, depth): what a row can score at most that a query has not met at that depth."""
        reading = np.where(read, queries, 0)
        others = queries - reading
        best = np.maximum(others, 0) @ self.top + np.minimum(others, 0) @ self.bottom
        return np.maximum(reading, 0) @ self.high.T + np.minimum(reading, 0) @ self.low.T + best[:, None]

    def search(self, queries: np.ndarray, own: np.ndarray, k: int, state: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """Improve each query's k best (scores, ids) by this block's rows."""
        n, dims = self.rows.shape
        queries = fitted(queries, dims)
        read = self.read_lists(queries) if dims else np.zeros(queries.shape, dtype=bool)
        bounds = self.bounds(queries, read)
        kth = np.array([scores[-1] if len(scores) == k else -np.inf for scores, _ in state])
        settled = bounds < kth[:, None]
        # how many depths are read at most; without a kth score yet the first look decides
        looks = np.where(settled.any(axis=1), settled.argmax(axis=1), len(self.depths) - 1)
        whole = (self.depths[looks] * read.sum(axis=1) >= n) & (kth > -np.inf)
        at = np.flatnonzero(whole)
        if len(at):
            self._score_all(queries[at], own[at], k, state, at)
        for q in np.flatnonzero(~whole):
            state[q] = self._walk(queries[q], np.flatnonzero(read[q]), bounds[q], own[q], k, *state[q])

    def _score_all(self, queries: np.ndarray, own: np.ndarray, k: int, state: list, at: np.ndarray) -> None:
        self.scored += len(at) * len(self.ids)
        found = queries @ self.rows.T
        for i, q in enumerate(at):
            scores, ids = state[q]
            good = np.flatnonzero(found[i] >= scores[-1])
            if len(good):
                state[q] = merge(scores, ids, found[i, good], self.ids[good], own[i], k)

    def _walk(
        self, query: np.ndarray, used: np.ndarray, bounds: np.ndarray, own: int, k: int, scores: np.ndarray, ids: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        n = len(self.ids)
        if not len(used):  # every row scores alike
            self.scored += n
            return merge(scores, ids, self.rows @ query, self.ids, own, k)
        down = query[used] > 0
        met = np.zeros(n, dtype=bool)
        before = 0
        for depth, bound in zip(self.depths, bounds, strict=True):
            new = np.zeros(n, dtype=bool)
            new[self.order[n - depth : n - before][:, used[down]]] = True
            new[self.order[before:depth][:, used[~down]]] = True
            new &= ~met
            met |= new
            at = np.flatnonzero(new)
            self.scored += len(at)
            scores, ids = merge(scores, ids, self.rows[at] @ query, self.ids[at], own, k)
            before = depth
            if len(scores) == k and bound < scores[-1]:
                break
        return scores, ids


def fitted(queries: np.ndarray, dims: int) -> np.ndarray:
    """The queries with so many components: zeros are added, what would meet only zeros is left out."""
    out = np.zeros((len(queries), dims))
    width = min(dims, queries.shape[1])
    out[:, :width] = queries[:, :width]
    return out


def merge(scores, ids, more_scores, more_ids, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of two sets, larger scores first, ties to the smaller id; `own` left out."""
    if len(scores) == k:
        good = more_scores >= scores[-1]
        more_scores, more_ids = more_scores[good], more_ids[good]
    other = more_ids != own
    scores = np.concatenate([scores, more_scores[other]])
    ids = np.concatenate([ids, more_ids[other]])
    best = np.lexsort((ids, -scores))[:k]
    return scores[best], ids[best]


PACKED = "number int, ids binary, rows binary, order binary, dims int"


def blocks(vectors: DataFrame, size: int, listed: bool) -> tuple[DataFrame, int]:
    """(number, ids, rows, order, dims) with about `size` vectors in each, and how many there are.

    listed: with the sorted lists; a block of up to 2**16 rows has two bytes for an entry.
    """
    n = max(1, -(-vectors.count() // size))
    dealt = vectors.withColumn("number", F.pmod(F.xxhash64("id", "v"), F.lit(n)).cast("int"))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        dims = max(map(len, pdf["v"]))
        rows = np.zeros((len(pdf), dims), dtype="<i4")
        for i, v in enumerate(pdf["v"]):
            rows[i, : len(v)] = v
        entry = "<u2" if len(pdf) <= 1 << 16 else "<u4"
        order = np.argsort(rows, axis=0, kind="stable").astype(entry).tobytes() if listed else b""
        ids = pdf["id"].to_numpy("<i8").tobytes()
        return pd.DataFrame({"number": pdf["number"].iloc[:1], "ids": [ids], "rows": [rows.tobytes()], "order": [order], "dims": [dims]})

    return dealt.groupBy("number").applyInPandas(pack, PACKED), n


def _unpacked(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, dims = np.frombuffer(row["ids"], "<i8"), row["dims"]
    entry = "<u2" if len(ids) <= 1 << 16 else "<u4"
    shape = (len(ids), dims)
    matrix = lambda data, kind: np.frombuffer(data, kind).reshape(shape) if data else np.zeros(shape, kind)
    return ids, matrix(row["rows"], "<i4"), matrix(row["order"], entry)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, block: int = BLOCK, batch: int = BATCH) -> DataFrame:
    """(query_id, rank, vec_id, score) for (id, v) queries against (id, v) vectors."""
    spark = vectors.sparkSession
    small_batches(spark)
    packed, n_blocks = blocks(vectors, block, listed=True)
    asked, n_batches = blocks(queries, batch, listed=False)
    packed, asked = stage(packed, "blocks"), stage(asked, "queries")
    # enough lanes of batches that all tasks have work, however few groups there are
    groups = -(-n_blocks // GROUP)
    lanes = min(n_batches, max(1, -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // groups)))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    held = packed.select(F.floor(F.col("number") / GROUP).cast("int").alias("group"), every(lanes).alias("lane"), F.lit(0).alias("kind"), "*")
    passing = asked.select(every(groups).alias("group"), F.pmod("number", F.lit(lanes)).alias("lane"), F.lit(1).alias("kind"), "*")
    # in a task come first a group's blocks, which it keeps, then the batches that it lets pass by
    spread = (
        held.unionByName(passing)
        .repartition(4 * groups * lanes, "group", "lane")
        .sortWithinPartitions("group", "lane", "kind", "number")
    )

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, lists = None, []
        for record in batches:
            for row in record.to_pylist():
                if (row["group"], row["lane"]) != key:
                    key, lists = (row["group"], row["lane"]), []
                ids, rows, order = _unpacked(row)
                if row["kind"] == 0:
                    lists.append(SortedLists(ids, rows, order))
                    continue
                state = [(np.zeros(0), np.zeros(0, np.int64))] * len(ids)
                for block_lists in lists:
                    block_lists.search(rows.astype(np.float64), ids, k, state)
                yield told(row["number"], ids, state)

    def told(number: int, asked_ids: np.ndarray, state: list) -> pa.RecordBatch:
        sizes = [len(ids) for _, ids in state]
        places = np.arange(len(sizes)) + (number << 32)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(places, sizes)),
                pa.array(np.repeat(asked_ids, sizes)),
                pa.array(np.concatenate([ids for _, ids in state])),
                pa.array(np.concatenate([scores for scores, _ in state]).astype(np.int64)),
            ],
            names=["place", "query_id", "vec_id", "score"],
        )

    found = spread.mapInArrow(walk, "place long, query_id long, vec_id long, score long")
    # the bests of a query's groups; a query is known by its batch and its place in it, so equal ids stay apart
    rank = F.row_number().over(W.partitionBy("place").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def search_report(embeddings: DataFrame) -> DataFrame:
    """The K best candidates of every query row."""
    vectors = stage(quantised(embeddings), "vectors")
    return top_k(vectors, vectors.filter(F.col("id") % QUERY_EVERY == 0))
