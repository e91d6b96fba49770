"""Exact ranks, quantiles, splits and AUC without one task seeing a whole group.

A plain window over a label or over everything would sort it in one task. Here
each value has a whole-number order key, and prefixes of that key cut the order
into ever smaller buckets. Small totals per prefix give each bucket its starting
rank; only rows of one finest bucket are sorted together, and the finest bucket
holds at most 65 536 distinct values, however the values are spread. The key of a
value depends on nothing but the value, so a recomputed task agrees with the rest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keepwell.functions.draws import digest
from keepwell.functions.ladders import ladder
from keepwell.functions.money import guarded_ratio

_MANTISSA = 52
_EXPONENT_SHIFT = 1100
_LARGEST = 1e280  # larger sizes, infinities and NaN share the last key
_LAST_KEY = 2**63 - 1
_PREFIX_SHIFTS = (40, 28, 16)


def order_key(value: Column) -> Column:
    """A long that never decreases with the value: binary exponent, then 52 bits of mantissa."""
    size = F.abs(value.cast("double"))
    exponent = F.floor(F.log2(size))
    mantissa = F.floor((size / F.pow(F.lit(2.0), exponent) - 1) * F.lit(2.0**_MANTISSA))
    key = (exponent + _EXPONENT_SHIFT) * F.lit(2**_MANTISSA) + mantissa
    bounded = F.when(F.isnan(size) | (size > _LARGEST), F.lit(_LAST_KEY)).otherwise(key)
    return F.when(size == 0, F.lit(0).cast("long")).when(value > 0, bounded).otherwise(-bounded)


def value_prefixes(value: Column) -> list[Column]:
    """4096 steps per power of two, each cut into 4096, each cut into 4096 again."""
    key = F.coalesce(order_key(value), F.lit(-_LAST_KEY))
    return [F.shiftright(key, bits) for bits in _PREFIX_SHIFTS]


def digest_prefixes(hex_digest: Column) -> list[Column]:
    """The first four hex digits: digests spread evenly, so 65 536 buckets of equal share do."""
    return [F.coalesce(F.substring(hex_digest, 1, 4), F.lit(""))]


def _as_parent(starts: DataFrame, keys: Sequence[str]) -> DataFrame:
    return starts.select(*keys, F.col("__start").alias("__before"), "whole")


def _bucket_starts(totals: DataFrame, groups: Sequence[str], levels: Sequence[str]) -> DataFrame:
    """Running total before each bucket, level by level; a level's window spans one parent bucket."""
    parent_keys, keys = [*groups, *levels[:-1]], [*groups, *levels]
    earlier = Window.partitionBy(*parent_keys).orderBy(levels[-1]).rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("__total").over(earlier), F.lit(0))
    if len(levels) == 1:
        whole = F.sum("__total").over(Window.partitionBy(*groups))
        return totals.select(*keys, inside.alias("__start"), whole.alias("whole"))
    coarser = totals.groupBy(*parent_keys).agg(F.sum("__total").alias("__total"))
    parents = _as_parent(_bucket_starts(coarser, groups, levels[:-1]), parent_keys)
    return (
        totals.withColumn("__inside", inside)
        .join(parents, parent_keys)
        .select(*keys, (F.col("__before") + F.col("__inside")).alias("__start"), "whole")
    )


def with_running_total(
    df: DataFrame, by: Sequence[str], order: str, amount: str, prefixes: Sequence[Column]
) -> DataFrame:
    """Adds `before` and `upto` (running totals of amount in order) and `whole` (group total).

    Rows must be unique on (by, order). Groups and buckets are named by columns that are
    never NULL, so a NULL group keeps its rows, and the join back and the window after it
    share one exchange.
    """
    named = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null"))
    groups = {f"__group{i}": named(c) for i, c in enumerate(by)}
    levels = {f"__level{i}": column for i, column in enumerate(prefixes)}
    keys = [*groups, *levels]
    tagged = df.withColumns({**groups, **levels})
    totals = tagged.groupBy(*keys).agg(F.sum(amount).alias("__total"))
    starts = _as_parent(_bucket_starts(totals, list(groups), list(levels)), keys)
    inside = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        tagged.join(starts, keys)
        .withColumn("upto", F.col("__before") + F.sum(amount).over(inside))
        .withColumn("before", F.col("upto") - F.col(amount))
        .drop("__before", *keys)
    )


def exact_quantiles(df: DataFrame, by: Sequence[str], value: str, shares: dict[str, float]) -> DataFrame:
    """Linear-interpolated quantiles per group, one output column per named share.

    Equal values are counted first, so a value shared by a third of all rows is one row here.
    """
    counted = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    ranked = with_running_total(counted, by, value, "n", value_prefixes(F.col(value)))

    def at(index: Column) -> Column:
        return F.max(F.when((F.col("before") <= index) & (index < F.col("upto")), F.col(value)))

    aggregates = [F.max("whole").alias("__n")]
    for name, share in shares.items():
        position = (F.col("whole") - 1) * F.lit(float(share))
        aggregates += [
            at(F.floor(position)).cast("double").alias(f"__lo_{name}"),
            at(F.ceil(position)).cast("double").alias(f"__hi_{name}"),
        ]

    def between(name: str, share: float) -> Column:
        position = (F.col("__n") - 1) * F.lit(float(share))
        low, high = F.col(f"__lo_{name}"), F.col(f"__hi_{name}")
        return (low + (high - low) * (position - F.floor(position))).alias(name)

    return ranked.groupBy(*by).agg(*aggregates).select(*by, *[between(n, s) for n, s in shares.items()])


def position_by_digest(df: DataFrame, by: Sequence[str], key: str, seed: int, stream: str = "order") -> DataFrame:
    """Adds `before` (0-based position of the key in a fixed pseudo-random order) and `whole`."""
    shuffled = df.withColumns({"__digest": digest(F.col(key), stream, seed), "__one": F.lit(1).cast("long")})
    ranked = with_running_total(shuffled, by, "__digest", "__one", digest_prefixes(F.col("__digest")))
    return ranked.drop("__digest", "__one", "upto")


def stratified_split(
    df: DataFrame, label: str, key: str, shares: Sequence[tuple[str, float]], seed: int
) -> DataFrame:
    """Adds `split`: exact shares within each label value, the same on every run."""
    placed = position_by_digest(df, [label], key, seed, "split")
    steps, running = [], 0.0
    for name, share in shares[:-1]:
        running = round(running + share, 10)
        steps.append((F.col("before") < F.col("whole") * F.lit(running), name))
    return placed.withColumn("split", ladder(steps, shares[-1][0])).drop("before", "whole")


def rank_auc(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Exact area under the ROC curve per group; ties count half."""
    counted = df.groupBy(*by, score).agg(
        F.count_if(F.col(label) == 1).alias("positives"), F.count_if(F.col(label) == 0).alias("negatives")
    )
    ranked = with_running_total(counted, list(by), score, "negatives", value_prefixes(F.col(score)))
    wins = F.col("positives") * (F.col("before") + F.col("negatives") / F.lit(2.0))
    return (
        ranked.groupBy(*by)
        .agg(
            F.sum(wins).alias("__wins"),
            F.sum("positives").alias("positives"),
            F.sum("negatives").alias("negatives"),
        )
        .withColumn(
            "roc_auc",
            guarded_ratio(F.col("__wins"), F.col("positives").cast("double") * F.col("negatives")),
        )
        .drop("__wins")
    )
