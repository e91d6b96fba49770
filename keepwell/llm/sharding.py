"""Shards of near equal bytes by histogram sort, in Spark expressions only. Law: `bytes`.

Rows are ordered by (hash of the text, hash of the id, staged position). Splitters are found by
probing: each round counts, over all partitions, the exact bytes below the borders of 2**PROBE_BITS
equal cells inside every open splitter's interval, and keeps the cell in which the splitter's
target falls, until the target is met within the tolerance. Then every row's bucket is known from the
splitters alone, and rows move once.

Equal texts are neighbours in the order and end up in one shard, unless a border within the tolerance
must fall inside their group, as it must when the group is larger than a shard.

Buckets are finer than shards, so numbering rows inside a shard needs no task over a whole shard: a
slot is the number of rows in earlier buckets of the shard plus the place inside the bucket.

Defined cases: a null text has only the fixed size of a row; null ids are ordered by their texts alone;
repeated rows differ in their staged position only; fewer rows than shards leave shards empty; an empty
table gives an empty result.
"""

from __future__ import annotations

import json
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from keepwell.llm.staging import stage

SHARDS = 24
BUCKETS_PER_SHARD = 8
ROW_BYTES = 8
PROBE_BITS = 10
# A border may miss its target by this part of a shard's bytes to keep equal texts together;
# borders between buckets of one shard by this part of a bucket's.
TOLERANCE = 0.01
INNER_TOLERANCE = 0.25
KEYS = ("k0", "k1", "k2")
KEY_BITS = (63, 63, 40)
STEPS = [(level, depth) for level, bits in enumerate(KEY_BITS) for depth in range(-(-bits // PROBE_BITS))]


def _place(level: int, depth: int) -> tuple[int, int]:
    """Lowest bit and width of a key's digit: PROBE_BITS at a time from the top."""
    low = max(0, KEY_BITS[level] - PROBE_BITS * (depth + 1))
    return low, KEY_BITS[level] - PROBE_BITS * depth - low


def _cell(level: int, depth: int) -> Column:
    low, width = _place(level, depth)
    return F.shiftright(F.col(KEYS[level]), low).bitwiseAND(F.lit((1 << width) - 1))


def _rest_of_key(value: int, level: int, depth: int) -> tuple[int, ...]:
    """The digits of a key's value from a depth on."""
    places = [_place(v, d) for v, d in STEPS if v == level and d >= depth]
    return tuple((value >> low) & ((1 << width) - 1) for low, width in places)


def _least_key(digits: tuple[int, ...]) -> tuple[int, int, int]:
    """The least key that begins with these digits; a last digit one too high carries over."""
    values = [0, 0, 0]
    for (level, depth), digit in zip(STEPS, digits, strict=False):
        values[level] += digit << _place(level, depth)[0]
    for level in (2, 1):
        if values[level] >> KEY_BITS[level]:
            values[level] -= 1 << KEY_BITS[level]
            values[level - 1] += 1
    return tuple(values)


def splitters(keyed: DataFrame, shards: int, per_shard: int) -> list[tuple[int, int, int]]:
    """The least key of every bucket but the first; the driver holds one border per bucket."""
    parts = shards * per_shard
    total = keyed.agg(F.sum("size")).first()[0] or 0
    if not total:
        return []
    borders = {
        j: {"rest": total * j / parts, "digits": ()} for j in range(1, parts)
    }
    least = {j: (INNER_TOLERANCE * total / parts if j % per_shard else TOLERANCE * total / shards) for j in borders}
    found: dict[int, tuple[int, int, int]] = {}
    for step, (level, depth) in enumerate(STEPS):
        probes = {j: b for j, b in borders.items() if j not in found and len(b["digits"]) == step}
        if not probes:
            continue
        for j, (cell, start, end, low, high) in _probe(keyed, step, probes).items():
            b = borders[j]
            if b["rest"] - start <= least[j]:
                found[j] = _least_key((*b["digits"], cell))
            elif end - b["rest"] <= least[j]:
                found[j] = _least_key((*b["digits"], cell + 1))
            else:
                b["rest"] -= start
                # a cell of a single key: go on with the next key at once
                b["digits"] += _rest_of_key(low, level, depth) if low == high else (cell,)
                if len(b["digits"]) == len(STEPS):
                    found[j] = _least_key(b["digits"])
    return [found[j] for j in sorted(found)]


def _probe(keyed: DataFrame, step: int, probes: dict[int, dict]) -> dict[int, tuple]:
    """For each border the cell its target falls in: (cell, bytes before it, bytes up to its end, least and greatest key)."""
    spark, (level, depth) = keyed.sparkSession, STEPS[step]
    path_of = lambda digits: ",".join(map(str, digits))
    path = F.concat_ws(",", *[_cell(v, d).cast("string") for v, d in STEPS[:step]])
    wanted = spark.createDataFrame(
        [(j, path_of(b["digits"]), float(b["rest"])) for j, b in probes.items()], "j int, path string, rest double"
    )
    paths = wanted.select("path").distinct()
    key = KEYS[level]
    # both small sides hold at most one row per border
    cells = (
        keyed.withColumn("path", path).join(F.broadcast(paths), "path")
        .groupBy("path", _cell(level, depth).alias("cell"))
        .agg(F.sum("size").alias("bytes"), F.min(key).alias("low"), F.max(key).alias("high"))
        .withColumn("upto", F.sum("bytes").over(W.partitionBy("path").orderBy("cell")))
    )
    hit = (F.col("rest") >= F.col("upto") - F.col("bytes")) & (F.col("bytes") > 0)
    placed = cells.join(F.broadcast(wanted), "path").filter(hit).groupBy("j").agg(
        F.max_by(F.struct("cell", (F.col("upto") - F.col("bytes")).alias("start"), "upto", "low", "high"), "cell").alias("c")
    )
    return {r["j"]: tuple(r["c"]) for r in placed.collect()}


def _bucket(borders: list[tuple[int, int, int]]) -> Column:
    """Number of borders up to the row's key: borders of earlier cells by table, those of its own cell by comparison."""
    cells: list[list[dict]] = [[] for _ in range(1 << PROBE_BITS)]
    low = _place(0, 0)[0]
    for border in borders:
        cells[min(border[0] >> low, len(cells) - 1)].append(dict(zip(KEYS, border, strict=True)))
    earlier = [0, *accumulate(len(c) for c in cells)][:-1]
    cell = _cell(0, 0).cast("int")
    own = F.get(F.from_json(F.lit(json.dumps(cells)), "array<array<struct<k0:bigint,k1:bigint,k2:bigint>>>"), cell)
    key = F.struct(*[F.col(k) for k in KEYS])
    before = F.get(F.from_json(F.lit(json.dumps(earlier)), "array<int>"), cell)
    return before + F.size(F.filter(own, lambda b: b <= key))


def with_keys(docs: DataFrame, text: Column, ident: Column) -> DataFrame:
    """docs with k0 (text), k1 (id), k2 (position), all non-negative."""
    return docs.withColumns(
        {
            "k0": F.shiftrightunsigned(F.xxhash64(text), 1),
            "k1": F.shiftrightunsigned(F.xxhash64(F.lit(1), ident), 1),
            "k2": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 40) - 1)),
        }
    )


def shard(keyed: DataFrame, shards: int = SHARDS, per_shard: int = BUCKETS_PER_SHARD) -> DataFrame:
    """keyed (k0, k1, k2, size and anything else) with `shard` and `slot`; rows move once.

    keyed must be staged: its keys are read several times and must not change.
    """
    borders = splitters(keyed, shards, per_shard)
    placed = keyed.withColumn("bucket", _bucket(borders))
    counts = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"))  # one row per bucket
    shard_of = F.floor(F.col("bucket") / per_shard).cast("int")
    offsets = counts.select(
        F.col("bucket").alias("b"), shard_of.alias("shard"),
        (F.sum("rows").over(W.partitionBy(shard_of).orderBy("bucket")) - F.col("rows")).alias("offset"),
    )
    numbered = placed.withColumn("place", F.row_number().over(W.partitionBy("bucket").orderBy(*KEYS)) - 1)
    joined = numbered.join(F.broadcast(offsets), F.col("bucket") == F.col("b"))
    return joined.withColumn("slot", F.col("offset") + F.col("place")).drop("bucket", "b", "offset", "place", *KEYS)


def shard_report(docs: DataFrame) -> DataFrame:
    """Per document: its size, checksum, shard and slot."""
    text = F.col("text")
    compact = docs.select(
        "doc_id", text,
        (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
    )
    keyed = stage(with_keys(compact, text, F.col("doc_id")).drop("text"), "shards")
    return shard(keyed).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
