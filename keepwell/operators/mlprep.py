"""Feature profile, encoding, scaling, imputation and metrics as DataFrame operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepwell import fixed_values as fixed
from keepwell.functions.money import guarded_ratio
from keepwell.operators.ranking import exact_quantiles

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def melted(df: DataFrame, keep: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Long form: one (feature, value) row per listed column."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns])
    return df.select(*keep, F.inline(pairs))


def profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: rows, missing values, mean, deviation and the five-number summary."""
    statistics = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[
            F.struct(
                F.count(c).alias("n"),
                F.avg(c).alias("mean"),
                F.stddev(c).alias("stddev"),
                F.min(c).cast("double").alias("low"),
                F.max(c).cast("double").alias("high"),
            ).alias(c)
            for c in columns
        ],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("feature"),
                F.col("__rows").alias("row_count"),
                (F.col("__rows") - F.col(f"{c}.n")).alias("missing"),
                F.col(f"{c}.mean").alias("mean"),
                F.col(f"{c}.stddev").alias("stddev"),
                F.col(f"{c}.low").alias("min"),
                F.col(f"{c}.high").alias("max"),
            )
            for c in columns
        ]
    )
    quartiles = exact_quantiles(melted(df, [], columns), ["feature"], "value", QUARTILES)
    return statistics.select(F.inline(rows)).join(quartiles, "feature", "left")


def class_balance(df: DataFrame, label: str = fixed.LABEL) -> DataFrame:
    """Rows and share per class, balanced class weights, and majority : minority."""
    counted = df.groupBy(label).agg(F.count(F.lit(1)).alias("customer_count"))
    totals = counted.agg(
        F.struct(
            F.sum("customer_count").alias("n"),
            F.count(F.lit(1)).alias("classes"),
            (F.max("customer_count") / F.min("customer_count")).alias("ratio"),
        )
    ).scalar()
    n = F.col("customer_count")
    return (
        counted.withColumn("__t", totals)
        .select(
            label,
            "customer_count",
            (n * 100.0 / F.col("__t.n")).alias("pct"),
            (F.col("__t.n") / (F.col("__t.classes") * n)).alias("class_weight"),
            F.col("__t.ratio").alias("imbalance_ratio"),
        )
    )


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, pairwise over non-null rows, in one pass."""
    pairs = list(combinations(columns, 2))
    measured = df.agg(
        *[
            F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c{i}")
            for i, (a, b) in enumerate(pairs)
        ]
    )
    rows = F.array(
        *[
            F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), F.col(f"c{i}").alias("correlation"))
            for i, (a, b) in enumerate(pairs)
        ]
    )
    return measured.select(F.inline(rows))


def label_correlations(df: DataFrame, columns: Sequence[str], label: str = fixed.LABEL) -> DataFrame:
    """Columns ranked by absolute correlation with the label."""
    measured = df.agg(*[F.corr(F.col(c).cast("double"), F.col(label).cast("double")).alias(c) for c in columns])
    rows = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.abs(F.col(c)).alias("abs_correlation")) for c in columns]
    )
    return measured.select(F.inline(rows)).orderBy(F.desc("abs_correlation"), "feature")


def quantiles_by_label(df: DataFrame, columns: Sequence[str], label: str = fixed.LABEL) -> DataFrame:
    """Box-plot figures of each column per label value."""
    shares = {"min": 0.0, **QUARTILES, "max": 1.0}
    return exact_quantiles(melted(df, [label], columns), [label, "feature"], "value", shares)


def fill_categories(df: DataFrame, columns: Sequence[str] = fixed.CATEGORICAL_FEATURES) -> DataFrame:
    return df.fillna(fixed.UNKNOWN_CATEGORY, subset=list(columns))


def category_levels(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Sorted levels of each column, for one_hot: a wide frame has a column for each, so the driver must know them.

    For columns whose levels grow with the data use one_hot_rows, which keeps them in rows.
    """
    long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("level")) for c in columns])))
    levels: dict[str, list[str]] = {c: [] for c in columns}
    for row in long.filter("level is not null").distinct().orderBy("column", "level").toLocalIterator():
        levels[row.column].append(row.level)
    return levels


def one_hot_rows(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Sparse one-hot encoding: a (key, column, level) row for each 1, without each column's first level.

    Any number of levels: none of them passes through the driver.
    """
    pairs = F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("level")) for c in columns]))
    long = df.select(key, pairs).filter("level is not null")
    first = long.groupBy("column").agg(F.min("level").alias("first_level"))  # one row per column
    return long.join(first, "column").filter("level <> first_level").select(key, "column", "level")


def one_hot(df: DataFrame, levels: Mapping[str, Sequence[str]]) -> DataFrame:
    """0/1 column per level, without the alphabetically first; the source columns go."""
    indicators = {
        f"{column}_{level}": F.when(F.col(column) == level, 1).otherwise(0)
        for column, names in levels.items()
        for level in list(names)[1:]
    }
    return df.withColumns(indicators).drop(*levels)


def fitted_medians(train: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Exact medians: one number per column reaches the driver."""
    rows = exact_quantiles(melted(train, [], columns), ["feature"], "value", {"median": 0.5}).collect()
    return {row.feature: row["median"] for row in rows}


def impute(df: DataFrame, values: Mapping[str, float]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(v)) for c, v in values.items()})


def fitted_scales(train: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column from one pass."""
    aggregates = []
    for c in columns:
        aggregates += [F.avg(c).alias(f"{c}_mean"), F.stddev_pop(c).alias(f"{c}_dev")]
    row = train.agg(*aggregates).first()
    return {c: (row[f"{c}_mean"], row[f"{c}_dev"]) for c in columns}


def scale(df: DataFrame, scales: Mapping[str, tuple[float, float]]) -> DataFrame:
    """(x - mean) / deviation; a constant column becomes 0."""
    return df.withColumns(
        {c: (F.col(c) - F.lit(mean)) / F.lit(dev or 1.0) for c, (mean, dev) in scales.items()}
    )


def confusion(label: str, prediction: str) -> dict[str, Column]:
    actual, said = F.col(label) == 1, F.col(prediction) == 1
    return {
        "tp": F.count_if(actual & said),
        "fp": F.count_if(~actual & said),
        "fn": F.count_if(actual & ~said),
        "tn": F.count_if(~actual & ~said),
    }


def _rates(prefix: str = "") -> dict[str, Column]:
    tp, fp, fn, tn = (F.col(f"{prefix}{name}") for name in ("tp", "fp", "fn", "tn"))
    return {
        f"{prefix}accuracy": guarded_ratio(tp + tn, tp + fp + fn + tn),
        f"{prefix}precision": guarded_ratio(tp, tp + fp),
        f"{prefix}recall": guarded_ratio(tp, tp + fn),
        f"{prefix}f1": guarded_ratio(tp * 2, tp * 2 + fp + fn),
    }


def binary_metrics(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Confusion counts, accuracy, precision, recall and F1 per group."""
    counted = df.groupBy(*by).agg(*[column.alias(name) for name, column in confusion(label, prediction).items()])
    return counted.withColumns(_rates())


def compare_predictions(df: DataFrame, label: str, model: str, rule: str, by: Sequence[str] = ()) -> DataFrame:
    """Agreement and quality of two predictions of the same label, from one pass."""
    said, ruled = F.col(model) == 1, F.col(rule) == 1
    aggregates = [
        F.count(F.lit(1)).alias("customers"),
        F.count_if(F.col(model) == F.col(rule)).alias("agreements"),
        F.count_if(said & ~ruled).alias("model_high_only"),
        F.count_if(~said & ruled).alias("rule_high_only"),
    ]
    for prefix, prediction in (("model_", model), ("rule_", rule)):
        aggregates += [c.alias(f"{prefix}{name}") for name, c in confusion(label, prediction).items()]
    kept = ("f1", "accuracy")
    rates = {
        name: column
        for prefix in ("model_", "rule_")
        for name, column in _rates(prefix).items()
        if name.removeprefix(prefix) in kept
    }
    return (
        df.groupBy(*by)
        .agg(*aggregates)
        .withColumns(rates)
        .withColumns(
            {
                "agreement_rate": guarded_ratio(F.col("agreements"), F.col("customers")),
                "f1_gain_pct": guarded_ratio((F.col("model_f1") - F.col("rule_f1")) * 100, F.col("rule_f1")),
            }
        )
        .drop(*[f"{p}{c}" for p in ("model_", "rule_") for c in ("tp", "fp", "fn", "tn")])
    )


def top_disagreements(df: DataFrame, model: str, rule: str, probability: str, n: int = 10) -> DataFrame:
    return (
        df.filter(F.col(model) != F.col(rule)).orderBy(F.desc(probability), "customer_id").limit(n)
    )
