"""Near-duplicate join on word shingles by vertical partitioning.

All shingles have one global order: rarer first, as a table of counts over hash slots says, then by
hash. Two sets that link share a shingle of their prefixes in that order, which proposes pairs. The
A parity sketch of each set then bounds the difference of a pair from below, which ends most of the pairs
that do not link. The order is cut into FRAGMENTS of equal mass; a pair's overlap is counted in each fragment
separately and summed. The rarest fragment comes first: pairs whose sum cannot reach the threshold any more end there.

Documents with one set of shingles are one class, and classes are the nodes. Only connectedness is
returned, so a crowded list of documents sharing a shingle is settled in two steps: all of it is compared
with its most central member; then only members of different components are compared, in blocks.

Defined cases: documents without words have no shingles and no links, their component is themselves;
with one to four words the whole sequence is the one shingle; null texts count as empty; null ids take
part but never name a component that has an id; repeated rows are copies; an empty table gives an
empty result; very long texts are handled whole; other columns are carried along whatever their names. Shingles are compared by 64-bit hashes, classes by 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepwell.llm.components import components
from keepwell.llm.staging import CHUNKS, carried, chunk_rows, gather, inner_tables, is_taken, light, small_batches, stage, taken_slots
from keepwell.llm.words import FACTORS, gram_hashes, mix, text_buffer, words_of

SHINGLE = 5
# Two sets link when PER * intersection >= LEAST * union.
LEAST, PER = 80, 100
# Slots (in bits) of the table of counts that orders shingles and of the one that picks documents.
COUNT_BITS = 20
PICK_BITS = 23
# Lists up to this long are compared in full at once; longer ones in blocks of BLOCK.
SHORT = 32
BLOCK = 512
FRAGMENTS = 4


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    data, offsets = text_buffer(column)
    words, _, _, at = words_of(data, offsets, fold_case=True)
    grams = gram_hashes(words, SHINGLE)
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        n = b - a
        if n >= SHINGLE:
            yield np.unique(grams[a : b - SHINGLE + 1])
        elif n:
            yield mix(np.array([(words[a:b] * FACTORS[16 : 16 + n]).sum(dtype=np.uint64) + np.uint64(n)]))
        else:
            yield np.zeros(0, np.uint64)


def class_of(shingles: np.ndarray) -> bytes | None:
    """128 bits that stand for the set."""
    if not len(shingles):
        return None
    first = mix(shingles * FACTORS[30]).sum(dtype=np.uint64)
    second = np.bitwise_xor.reduce(mix(shingles + FACTORS[31])) + np.uint64(len(shingles))
    return int(first).to_bytes(8, "big") + int(second).to_bytes(8, "big")


def prefix_length(n: int) -> int:
    """Shingles of which two linked sets share one: at most 20 % can be missing from either."""
    return n - -(-LEAST * n // PER) + 1


def least_overlap(a, b):
    """Smallest intersection with which sets of these sizes link."""
    return least_overlap_of(a + b)


def least_overlap_of(sizes):
    """The same by the sum of the two sizes."""
    return -(-LEAST * sizes // (PER + LEAST))


# The sketch of the largest set has so many bits (as a power of two); those of smaller sets are folded to fit.
LEAST_SKETCH, MOST_SKETCH = 6, 16


def sketch(shingles: np.ndarray) -> bytes:
    """One bit for each slot of the hashes: whether an odd number of them fall there.

    Two sets' sketches differ in at most as many bits as the sets differ in shingles. Twice as many slots as
    shingles or more, as far as MOST_SKETCH goes.
    """
    bits = min(max(int(len(shingles)).bit_length(), LEAST_SKETCH), MOST_SKETCH)
    slots = (shingles & np.uint64((1 << bits) - 1)).astype(np.int64)
    return np.packbits(np.bincount(slots, minlength=1 << bits) & 1, bitorder="little").tobytes()


def least_difference(a: bytes, b: bytes) -> int:
    """A bound from below for the number of shingles in which the sets of two sketches differ."""
    x, y = (np.frombuffer(s, np.uint8) for s in ((a, b) if len(a) >= len(b) else (b, a)))
    if len(x) > len(y):  # the low bits of a slot are its slot in a smaller sketch
        x = np.bitwise_xor.reduce(x.reshape(-1, len(y)), axis=0)
    return int(np.bitwise_count(x ^ y).sum())


def _ordered(shingles: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The set in the global order."""
    slots = counts[(shingles >> np.uint64(64 - COUNT_BITS)).astype(np.int64)]
    return shingles[np.lexsort((shingles, slots))]


def _classes(docs: DataFrame, ident: str, text: str) -> tuple[DataFrame, np.ndarray]:
    """(ident, n, cls) per row, and the table of counts, from one pass over the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << COUNT_BITS, dtype=np.uint32)
        for batch in batches:
            sizes, names, slots = [], [], [np.zeros(0, np.int32)]
            for shingles in shingle_sets(batch.column(1)):
                sizes.append(len(shingles))
                names.append(class_of(shingles))
                slots.append((shingles >> np.uint64(64 - COUNT_BITS)).astype(np.int32))
            counts += np.bincount(np.concatenate(slots), minlength=len(counts)).astype(np.uint32)
            none = pa.nulls(len(sizes), pa.int32()), pa.nulls(len(sizes), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(names, pa.binary()), *none], names=columns
            )
        for chunk in chunk_rows(counts):
            k = chunk.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.binary()), *chunk.columns], names=columns
            )

    columns = ["ident", "n", "cls", "chunk", "counts"]
    rows = docs.select(F.col(ident).cast("long").alias("ident"), F.col(text).alias("text"))
    found = stage(rows.mapInArrow(run, f"ident long, n long, cls binary, {CHUNKS}"), "classes")
    table = gather(found.filter("chunk is not null").select("chunk", "counts"), COUNT_BITS)
    return found.filter("chunk is null").select("ident", "n", "cls"), table


def _prefixes(docs: DataFrame, text: str, sent) -> DataFrame:
    """(cls, n, prefix, sketch) of every class, once for each task that meets the class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, met = sent.value, set()
        for batch in batches:
            out: tuple[list, list, list, list] = ([], [], [], [])
            for shingles in shingle_sets(batch.column(0)):
                cls = class_of(shingles)
                if cls is None or cls in met:
                    continue
                if len(met) >= 200_000:
                    met.clear()
                met.add(cls)
                prefix = _ordered(shingles, counts)[: prefix_length(len(shingles))]
                for to, value in zip(out, (cls, len(shingles), prefix.view(np.int64), sketch(shingles)), strict=True):
                    to.append(value)
            kinds = pa.binary(), pa.int32(), pa.list_(pa.int64()), pa.binary()
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, kind) for values, kind in zip(out, kinds, strict=True)], names=["cls", "n", "prefix", "sketch"]
            )

    return docs.select(F.col(text).alias("text")).mapInArrow(run, "cls binary, n int, prefix array<long>, sketch binary")


def _can_link(n_a, p_a, n_b, p_b):
    """Whether sets whose first shared shingle stands at these places can still link."""
    return np.minimum(n_a - p_a, n_b - p_b) >= least_overlap(n_a, n_b)


PAIRS = "a binary, b binary, n_a int, n_b int"


MET = "a binary, b binary, n_a int, n_b int, h long, p int"


def _first_pairs(postings: DataFrame) -> DataFrame:
    """Pairs (a, b) from lists of classes that share a shingle of their prefixes, and the members (a, h, p) of long lists.

    Lists come sorted by place, so the first member is the one with the fewest rarer shingles. Short
    lists give all their pairs, longer ones the pairs with the first member; either only where the
    pair can still link. No more than SHORT members of a list are held at once. Longer lists are handed on here,
    so the postings are shuffled once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, members = None, []
        for batch in batches:
            out: list[tuple] = []
            columns = [batch.column(i).to_pylist() for i in range(4)]
            for h, cls, n, p in zip(*columns, strict=True):
                if h != key:
                    key, members = h, []
                elif cls == members[-1][0]:
                    continue  # a copy met by another task
                for other, m, q in members if len(members) <= SHORT else members[:1]:
                    if other != cls and _fits(n, p, m, q):
                        (a, n_a), (b, n_b) = ((cls, n), (other, m)) if cls < other else ((other, m), (cls, n))
                        out.append((a, b, n_a, n_b, None, None))
                if len(members) < SHORT:
                    members.append((cls, n, p))
                elif len(members) == SHORT:
                    members.append((cls, n, p))
                    out.extend((c, None, k, None, h, q) for c, k, q in members)
                else:
                    members[-1] = (cls, n, p)
                    out.append((cls, None, n, None, h, p))
            kinds = pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.int64(), pa.int32()
            yield pa.RecordBatch.from_arrays(
                [pa.array([row[i] for row in out], kind) for i, kind in enumerate(kinds)], names=["a", "b", "n_a", "n_b", "h", "p"]
            )

    return postings.mapInArrow(run, MET)


def _near_enough(pairs: DataFrame, prefixes: DataFrame) -> DataFrame:
    """The pairs that can link by their sketches: linked sets differ in no more than their smallest overlap leaves."""
    sketches = prefixes.select("cls", "sketch").dropDuplicates(["cls"])
    side = lambda s: sketches.select(F.col("cls").alias(s), F.col("sketch").alias(f"sketch_{s}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(2).to_numpy().astype(np.int64) + batch.column(3).to_numpy()
            most = sizes - 2 * least_overlap_of(sizes)
            found = [
                least_difference(x.as_py(), y.as_py()) <= m
                for x, y, m in zip(batch.column(4), batch.column(5), most.tolist(), strict=True)
            ]
            yield batch.select(["a", "b", "n_a", "n_b"]).filter(pa.array(found, pa.bool_()))

    return both.mapInArrow(run, PAIRS)


def _fits(n: int, p: int, m: int, q: int) -> bool:
    return min(n - p, m - q) >= -(-LEAST * (n + m) // (PER + LEAST))


def _later_pairs(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs of different components from the (h, cls, n, p) members of lists longer than SHORT."""
    sizes = members.groupBy("h").agg(F.count(F.lit(1)).alias("m"))
    long_lists = members.join(sizes, "h").join(roots, F.col("cls") == F.col("node"), "left")
    root = F.coalesce("root", "cls")
    long_lists = stage(long_lists.select("h", "cls", "n", "p", "m", root.alias("root")).distinct(), "lists")
    mixed = long_lists.groupBy("h").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).filter("r0 <> r1")
    blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("cls"), blocks).cast("int")
    placed = long_lists.join(mixed.select("h"), "h").withColumn("blocks", blocks).withColumn("own", own)
    spread = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    meeting = spread.select(
        "h", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "cls", "n", "p", "root"
    )

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        own, n, p = pdf["own"].to_numpy(), pdf["n"].to_numpy(np.int64), pdf["p"].to_numpy(np.int64)
        root = pd.factorize(pdf["root"])[0]
        left = np.flatnonzero(own == pdf["x"].iloc[0])
        right = np.flatnonzero(own == pdf["y"].iloc[0])
        ok = (root[left][:, None] != root[right]) & _can_link(n[left][:, None], p[left][:, None], n[right], p[right])
        i, j = np.nonzero(ok)
        a, b = pdf["cls"].to_numpy()[left[i]], pdf["cls"].to_numpy()[right[j]]
        n_a, n_b = n[left[i]].astype(np.int32), n[right[j]].astype(np.int32)
        ordered = np.fromiter((x < y for x, y in zip(a, b, strict=True)), bool, len(a))
        return pd.DataFrame(
            {
                "a": np.where(ordered, a, b), "b": np.where(ordered, b, a),
                "n_a": np.where(ordered, n_a, n_b), "n_b": np.where(ordered, n_b, n_a),
            }
        )

    return meeting.groupBy("h", "x", "y").applyInPandas(compare, PAIRS)


def _fragment_of_slot(counts: np.ndarray) -> np.ndarray:
    """Fragment of each slot: the slots in order, cut where the mass passes a share of the total."""
    order = np.lexsort((np.arange(len(counts)), counts))
    mass = np.cumsum(counts[order].astype(np.float64))
    out = np.empty(len(counts), dtype=np.uint8)
    out[order] = np.minimum(mass * FRAGMENTS / max(mass[-1], 1.0), FRAGMENTS - 1).astype(np.uint8)
    return out


def _fragments(docs: DataFrame, text: str, cut, picked) -> DataFrame:
    """(cls, fragment, hashes, n_rest) of the classes whose slot is picked.

    hashes: sorted, as bytes; n_rest: shingles of the class in later fragments. A class is met once per task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fragment_of, wanted, met = cut.value, picked.value, set()
        for batch in batches:
            out: tuple[list, list, list, list] = ([], [], [], [])
            for shingles in shingle_sets(batch.column(0)):
                cls = class_of(shingles)
                if cls is None or cls in met or not is_taken(wanted, np.array([_slot(cls)]))[0]:
                    continue
                if len(met) >= 200_000:
                    met.clear()
                met.add(cls)
                which = fragment_of[(shingles >> np.uint64(64 - COUNT_BITS)).astype(np.int64)]
                for f in range(FRAGMENTS):
                    values = cls, f, shingles[which == f].tobytes(), int((which > f).sum())
                    for to, value in zip(out, values, strict=True):
                        to.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.binary()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.binary()), pa.array(out[3], pa.int32())],
                names=["cls", "fragment", "hashes", "n_rest"],
            )

    return docs.select(F.col(text).alias("text")).mapInArrow(
        run, "cls binary, fragment int, hashes binary, n_rest int"
    ).dropDuplicates(["cls", "fragment"])


def _slot(cls: bytes) -> int:
    return int.from_bytes(cls[:8], "big") >> (64 - PICK_BITS)


def _partial_overlaps(pairs: DataFrame, fragments: DataFrame) -> DataFrame:
    """pairs (a, b, fragment ...) with `common`, the overlap in the fragment, and what is left of the smaller rest."""
    side = lambda s: fragments.select(
        F.col("cls").alias(s), "fragment", F.col("hashes").alias(f"hashes_{s}"), F.col("n_rest").alias(f"rest_{s}")
    )
    both = pairs.join(side("a"), ["a", "fragment"]).join(side("b"), ["b", "fragment"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            common = [
                len(np.intersect1d(np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8"), assume_unique=True))
                for x, y in zip(batch.column(4), batch.column(5), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(4)], pa.array(common, pa.int32()), batch.column(6)],
                names=["a", "b", "n_a", "n_b", "common", "rest"],
            )

    return both.select("a", "b", "n_a", "n_b", "hashes_a", "hashes_b", F.least("rest_a", "rest_b").alias("rest")).mapInArrow(
        count, PAIRS + ", common int, rest int"
    )


def _linked(pairs: DataFrame, docs: DataFrame, text: str, cut) -> DataFrame:
    """The pairs (a, b) that link, staged."""
    spark = pairs.sparkSession
    with inner_tables(spark):
        return stage(_verified(pairs, docs, text, cut), "links", kept=True)


def _verified(pairs: DataFrame, docs: DataFrame, text: str, cut) -> DataFrame:
    spark = pairs.sparkSession
    ends = pairs.select(F.explode(F.array("a", "b")).alias("cls"))
    high = F.conv(F.hex(F.substring("cls", 1, 8)), 16, -10).cast("long").alias("slot")  # as _slot reads it
    picked = spark.sparkContext.broadcast(taken_slots(ends.select(high), "slot", PICK_BITS))
    fragments = stage(_fragments(docs, text, cut, picked), "fragments")
    needed = (F.lit(LEAST) * (F.col("n_a") + F.col("n_b")) + (PER + LEAST - 1)) / F.lit(PER + LEAST)
    needed = F.floor(needed)
    first = _partial_overlaps(pairs.withColumn("fragment", F.lit(0)), fragments.filter("fragment = 0"))
    open_ = stage(first.filter(F.col("common") + F.col("rest") >= needed).drop("rest"), "overlaps")
    later = open_.drop("common").withColumn("fragment", F.explode(F.sequence(F.lit(1), F.lit(FRAGMENTS - 1))))
    rest = _partial_overlaps(later, fragments.filter("fragment > 0")).drop("rest")
    total = open_.unionByName(rest).groupBy("a", "b", "n_a", "n_b").agg(F.sum("common").alias("common"))
    return total.filter(F.col("common") >= needed).select("a", "b")


def near_duplicates(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row, staged."""
    spark = docs.sparkSession
    small_batches(spark)
    with inner_tables(spark):
        rows, counts = _classes(docs, ident, text)
        sent = spark.sparkContext.broadcast(counts)
        cut = spark.sparkContext.broadcast(_fragment_of_slot(counts))
        roots = _roots(docs, text, sent, cut)
        return stage(_with_components(rows, roots), "components", kept=True)


def _roots(docs: DataFrame, text: str, sent, cut) -> DataFrame:
    """(node, root) of the linked classes, staged."""
    with inner_tables(docs.sparkSession):
        prefixes = stage(_prefixes(docs, text, sent), "prefixes")
        postings = prefixes.select("cls", "n", F.posexplode("prefix").alias("p", "h")).select("h", "cls", "n", "p")
        sorted_lists = postings.repartition("h").sortWithinPartitions("h", "p", "n", "cls")
        met = stage(_first_pairs(sorted_lists), "met")
        pairs = stage(met.filter("h is null").select("a", "b", "n_a", "n_b").distinct(), "pairs")
        long_lists = met.filter("h is not null").select("h", F.col("a").alias("cls"), F.col("n_a").alias("n"), "p")
        links = _linked(stage(_near_enough(pairs, prefixes), "near"), docs, text, cut)
        roots = components(links, "a", "b")
        more = stage(_later_pairs(long_lists, roots).distinct().join(pairs, ["a", "b"], "left_anti"), "pairs")
        if not more.isEmpty():
            later = _linked(stage(_near_enough(more, prefixes), "near"), docs, text, cut)
            roots = components(links.unionByName(later), "a", "b")
        return stage(roots, "roots", kept=True)


# A class of more than one in so many rows is hot: there are fewer such classes than this.
HOT_SHARE = 1000


def _with_components(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """The component of every row: the least id among the classes of its root.

    Ids are combined to one for each class and each root before anything is joined. Rows then look up
    their class; the few hot classes, fewer than HOT_SHARE whatever the input, are broadcast to their rows.
    """
    classes = rows.filter("cls is not null").groupBy("cls").agg(F.min("ident").alias("least"), F.count(F.lit(1)).alias("m"))
    named = classes.join(roots, F.col("cls") == F.col("node"), "left").withColumn("root", F.coalesce("root", "cls"))
    least = named.groupBy("root").agg(F.min("least").alias("component"))
    found = stage(named.select("cls", "m", "root").join(least, "root").select("cls", "m", "component"), "named")
    total = rows.count()
    hot = F.broadcast(found.filter(F.col("m") * HOT_SHARE > total).select("cls", "component", F.lit(True).alias("hot")))
    looked_up = rows.join(hot, "cls", "left")
    done = looked_up.filter("hot or cls is null").select("ident", "n", "component")
    others = looked_up.filter("hot is null and cls is not null").select("ident", "n", "cls").join(
        found.filter(F.col("m") * HOT_SHARE <= total).select("cls", "component"), "cls"
    )
    return done.unionByName(others.select("ident", "n", "component")).select(
        F.col("ident").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component", "ident").alias("component_id")
    )


def first_of_each(docs: DataFrame) -> DataFrame:
    """docs with one document of each component: the one with the smallest id.

    Rows that share an id (or have none) are told apart by their texts, and of equal rows one stays.
    Only ids travel to the comparison with the texts' table; as long as they are light, the texts stay where they are.
    """
    found = near_duplicates(docs)
    same = F.col("component_id").eqNullSafe(F.col("doc_id"))
    kept = found.filter(same | F.col("doc_id").isNull()).groupBy("doc_id").agg(F.count(F.lit(1)).alias("m"))
    kept = light(stage(kept.withColumnRenamed("doc_id", "id"), "kept"))
    joined = carried(docs, ident=F.col("doc_id").cast("long")).join(kept, F.col("ident").eqNullSafe(F.col("id")))
    single = joined.filter("m = 1").select("row")
    repeated = joined.filter("m > 1").withColumn("text", F.col("row.text")).dropDuplicates(["ident", "text"])
    return single.unionByName(repeated.select("row")).select("row.*")
