"""Mix sources to target weights, in Spark expressions only.

Each document has a hash-random key. Within its source the documents are ordered by it; running
totals of their sizes say where the source's budget ends. Whole epochs are taken first, the rest
is a prefix of the order, up to the very word where what is left is used up. Running totals are made in
two levels: totals of key ranges, then single documents inside the one range where the cut falls.

Defined cases: a null text has size 0 and is never taken; a null source is a source of its own,
ordered last; rows with equal id, text and source have equal keys and are taken together; an
empty table gives an empty result; texts of any length count whole; mixed_documents carries other columns along whatever
their names. Equal sizes need no tie-break: the key decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from keepwell.llm.staging import carried, stage

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
SEED = 20260701
# Key ranges per source: the top RANGE_BITS bits of the key.
RANGE_BITS = 12


def size_in_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^ \\t-\\r]+")), F.lit(0)).cast("long")


def key_of(*columns: Column) -> Column:
    return F.xxhash64(F.lit(SEED), *columns)


def _range(key: Column) -> Column:
    return F.shiftright(key, 64 - RANGE_BITS)


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target, epochs, rest) from (source, size) rows.

    Sources in code point order, null last, weigh WEIGHTS in turn and share the whole corpus's size;
    none gets more than MAX_REPEATS times its own size. The excess goes to the others by weight: with
    sources ordered by the share at which each is full, the full ones are a prefix of that order.
    One row per source from here on.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = W.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(WEIGHTS)
    weight = F.get(F.array(*[F.lit(w) for w in WEIGHTS]), turn)
    weighed = per_source.withColumn("weight", weight).withColumn("full", MAX_REPEATS * F.col("source_size"))
    by_share = W.orderBy(F.col("full") / F.col("weight"), F.col("source").asc_nulls_last())
    upto = by_share.rowsBetween(W.unboundedPreceding, -1)
    every = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    share = (F.sum("source_size").over(every) - F.coalesce(F.sum("full").over(upto), F.lit(0))) / (
        F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(upto), F.lit(0))
    )
    # the share of the first source that is not full holds for it and all after it
    first_open = F.min(F.when(F.col("full") >= F.col("share") * F.col("weight"), F.struct("rank", "share"))).over(every)
    solved = (
        weighed.withColumn("share", share)
        .withColumn("rank", F.row_number().over(by_share))
        .withColumn("open", first_open)
    )
    target = F.when(F.col("rank") < F.col("open.rank"), F.col("full").cast("double")).otherwise(
        F.least(F.col("open.share") * F.col("weight"), F.col("full").cast("double"))
    )
    out = solved.select("source", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    return out.withColumn("epochs", epochs.cast("long")).withColumn(
        "rest", F.col("target") - F.col("epochs") * F.col("source_size")
    )


def cuts(keyed: DataFrame) -> DataFrame:
    """targets() with the key at which the rest ends and the words taken of the document there; earlier keys are taken once more."""
    budget = stage(targets(keyed), "targets")
    ranges = keyed.groupBy("source", _range(F.col("key")).alias("range")).agg(F.sum("size").alias("range_size"))
    before = F.sum("range_size").over(W.partitionBy("source").orderBy("range")) - F.col("range_size")
    placed = ranges.withColumn("before", before)
    b = budget.select(F.col("source").alias("s"), "rest")
    # the range in which the rest ends; where it ends on a border, nothing is left to look for inside
    open_range = placed.join(b, placed["source"].eqNullSafe(b["s"])).filter(
        "before <= rest and rest < before + range_size"
    )
    open_range = stage(open_range.select("s", F.col("range").alias("r"), "before", "rest"), "ranges")
    inside = keyed.join(
        open_range, keyed["source"].eqNullSafe(open_range["s"]) & (_range(keyed["key"]) == open_range["r"])
    )
    by_key = inside.groupBy("s", "key", "before", "rest").agg(
        F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows")
    )
    running = F.col("before") + F.sum("size").over(W.partitionBy("s").orderBy("key"))
    first_beyond = (
        by_key.withColumn("total", running).filter("total > rest").groupBy("s")
        .agg(F.min(F.struct("key", (F.col("rest") - F.col("total") + F.col("size")).alias("part"), "rows")).alias("c"))
    )
    cut = first_beyond.select(
        "s", F.col("c.key").alias("cut_key"), F.floor(F.col("c.part") / F.col("c.rows")).alias("cut_part")
    )
    return budget.join(cut, budget["source"].eqNullSafe(cut["s"]), "left").drop("s")


def mix(docs: DataFrame, source: Column, size: Column, key: Column, whole: bool) -> DataFrame:
    """docs with `_source`, `_size`, `_source_size`, `_target` and `_taken`.

    The document at which a budget ends is taken in part, so that the budget is met to the word; with
    `whole`, all of it or nothing, whichever is nearer.
    """
    keyed = docs.withColumns({"_source": source, "_size": size, "_key": key})
    compact = keyed.select(F.col("_source").alias("source"), F.col("_size").alias("size"), F.col("_key").alias("key"))
    plan = stage(cuts(compact), "cuts")
    plan = plan.select(
        F.col("source").alias("_s"), F.col("source_size").alias("_source_size"), F.col("target").alias("_target"),
        F.col("epochs").alias("_epochs"), F.col("cut_key").alias("_cut"), F.col("cut_part").alias("_part"),
    )
    joined = keyed.join(plan, keyed["_source"].eqNullSafe(plan["_s"]))
    part = F.least(F.col("_part"), F.col("_size"))
    if whole:
        part = F.when(2 * part >= F.col("_size"), F.col("_size")).otherwise(F.lit(0))
    more = F.when(F.col("_key") < F.col("_cut"), F.col("_size")).when(F.col("_key") == F.col("_cut"), part)
    taken = F.col("_epochs") * F.col("_size") + F.coalesce(more, F.lit(0))
    return joined.withColumn("_taken", taken.cast("long")).drop("_s", "_epochs", "_cut", "_part", "_key")


def mixture_report(docs: DataFrame) -> DataFrame:
    """Per document: its size, its source's size and target, and the words taken from it."""
    compact = stage(
        docs.select(
            "doc_id", "source", size_in_words(F.col("text")).alias("size"), key_of(F.col("doc_id"), F.col("text")).alias("key")
        ),
        "sizes",
    )
    mixed = mix(compact, F.col("source"), F.col("size"), F.col("key"), whole=False)
    return mixed.select(
        "doc_id", "size", F.col("_source_size").alias("source_size"), F.col("_target").alias("target"),
        F.col("_taken").alias("taken"),
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: every document as often as it is taken, with its own columns, whatever these are called."""
    rows = carried(docs, doc_id=F.col("doc_id"), source=F.col("source"), text=F.col("text"))
    mixed = mix(
        rows, F.col("source"), size_in_words(F.col("text")), key_of(F.col("doc_id"), F.col("text")), whole=True
    )
    times = F.when(F.col("_size") > 0, (F.col("_taken") / F.col("_size")).cast("int")).otherwise(F.lit(0))
    return (
        mixed.withColumn("_times", times).filter("_times > 0")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times"))))
        .select("row.*")
    )
