"""Tables staged in the cluster's shared folder, and tables folded to a fixed size."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keepwell.session import fresh_path
from keepwell.sources.files import SharedFiles

# Arrow batches that go to Python workers: rows may be long texts, so both bounds hold.
BATCH_ROWS = 512
BATCH_BYTES = 8 << 20
# Slots of a folded table that travel in one row.
CHUNK_BITS = 13


# Folders of the tables staged in each open scope, the innermost last. A driver runs one operator at a time.
_scopes: list[list[str]] = [[]]


def stage(df: DataFrame, name: str, kept: bool = False) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends here and lost executors cost nothing.

    kept: the table outlives the innermost scope and belongs to the one around it.
    """
    path = fresh_path(df.sparkSession, name)
    _scopes[-2 if kept and len(_scopes) > 1 else -1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scope(paths: list[str]) -> Iterator[None]:
    """Note the folders of the tables staged meanwhile in `paths`."""
    _scopes.append(paths)
    try:
        yield
    finally:
        _scopes.pop()


@contextmanager
def inner_tables(spark: SparkSession) -> Iterator[None]:
    """Delete the tables staged in the block when it ends, but for those kept: nothing may read them any more."""
    paths: list[str] = []
    try:
        with scope(paths):
            yield
    finally:
        drop(spark, paths)


def drop(spark: SparkSession, paths: list[str]) -> None:
    """Delete staged tables and empty the list."""
    files = SharedFiles(spark)
    while paths:
        files.delete(paths.pop())


# Tables of fixed-width rows up to so many bytes are broadcast rather than shuffled against whole texts.
LIGHT = 32 << 20


def light(df: DataFrame) -> DataFrame:
    """df marked for a broadcast join if its rows, counted now, hold no more than LIGHT bytes; else as it is.

    Rows must be of fixed width, or hold arrays of such.
    """
    # 16 bytes for a row, a plain value and an array's entry are more than they take
    arrays = {f.name for f in df.schema.fields if f.dataType.typeName() == "array"}
    entries = sum((F.coalesce(F.size(f"`{name}`"), F.lit(0)) for name in arrays), F.lit(1 + len(df.columns)))
    held = 16 * (df.agg(F.sum(entries)).first()[0] or 0)
    return F.broadcast(df) if held <= LIGHT else df


def carried(docs: DataFrame, **needed: Column) -> DataFrame:
    """docs with each row as the one struct `row` beside the needed columns, so no name of docs can clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *[c.alias(n) for n, c in needed.items()])


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of the queries planned from now on."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def taken_slots(df: DataFrame, column: str, bits: int) -> np.ndarray:
    """Which of 2**bits slots (a 64-bit hash's top bits) hold a value of the column.

    A filter of fixed size, whatever the input: 2**bits / 8 bytes come to the driver. More values fill
    more slots, which lets more rows through and loses none.
    """
    chunk_bits = min(bits, CHUNK_BITS)
    slot = F.shiftrightunsigned(F.col(column), 64 - bits).cast("int")
    slots = df.select(slot.alias("slot")).distinct().withColumn("chunk", F.shiftright("slot", chunk_bits))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        held = np.zeros(1 << chunk_bits, dtype=bool)
        held[pdf["slot"].to_numpy() & ((1 << chunk_bits) - 1)] = True
        return pd.DataFrame({"chunk": pdf["chunk"].iloc[:1], "held": [np.packbits(held).tobytes()]})

    table = np.zeros((1 << (bits - chunk_bits), (1 << chunk_bits) // 8), dtype=np.uint8)
    for row in slots.groupBy("chunk").applyInPandas(pack, "chunk int, held binary").toLocalIterator():
        table[row[0]] = np.frombuffer(row[1], dtype=np.uint8)
    return table.ravel()


def is_taken(table: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Look slots up in what taken_slots returned."""
    return (table[slots >> 3] >> (7 - (slots & 7)).astype(np.uint8)) & 1 == 1


CHUNKS = "chunk int, counts binary"


def chunk_rows(counts: np.ndarray, size: int = 1 << CHUNK_BITS) -> Iterator[pa.RecordBatch]:
    """The chunks of a table that are not all zero, as rows of the CHUNKS schema."""
    parts = counts.astype("<u4", copy=False).reshape(-1, min(size, len(counts)))
    full = np.flatnonzero(parts.any(axis=1))
    if len(full):
        yield pa.RecordBatch.from_arrays(
            [pa.array(full.astype(np.int32)), pa.array([parts[i].tobytes() for i in full], pa.binary())],
            names=["chunk", "counts"],
        )


def gather(chunks: DataFrame, bits: int) -> np.ndarray:
    """Add up the chunks of many tables; 2**bits counts arrive at the driver."""

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(c, dtype="<u4").astype(np.uint64) for c in pdf["counts"])
        total = np.minimum(total, np.iinfo(np.uint32).max).astype("<u4")
        return pd.DataFrame({"chunk": pdf["chunk"].iloc[:1], "counts": [total.tobytes()]})

    # two levels: the tables of many tasks never meet in one group at once
    salted = chunks.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(16)))
    partial = salted.groupBy("chunk", "salt").applyInPandas(
        lambda pdf: add(pdf[["chunk", "counts"]]), CHUNKS
    )
    table = np.zeros(1 << bits, dtype=np.uint32)
    size = min(1 << bits, 1 << CHUNK_BITS)
    for row in partial.groupBy("chunk").applyInPandas(add, CHUNKS).toLocalIterator():
        table[row[0] * size : (row[0] + 1) * size] = np.frombuffer(row[1], dtype="<u4")
    return table
