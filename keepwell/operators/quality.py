"""Declared quality rules: count, flag, drop and quarantine.

A predicate that evaluates to NULL counts as violated.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from keepwell import fixed_values as fixed
from keepwell.functions.text import mask_tail


@dataclass(frozen=True)
class Rule:
    name: str
    predicate: str
    drop: bool = False

    @property
    def action(self) -> str:
        return "drop" if self.drop else "keep"

    @property
    def holds(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))


_TIERS = ", ".join(f"'{tier}'" for tier in fixed.LOYALTY_TIERS)

PRODUCT_RULES = (
    Rule("valid_product_id", "product_id IS NOT NULL"),
    Rule("valid_price", "price >= 0"),
)
CUSTOMER_RULES = (
    Rule("valid_customer_id", "customer_id IS NOT NULL", drop=True),
    Rule("valid_email", "email IS NOT NULL AND email LIKE '%@%'"),
)
LOYALTY_RULES = (
    Rule("valid_customer_id", "customer_id IS NOT NULL"),
    Rule("valid_tier", f"loyalty_tier IN ({_TIERS})"),
)
ORDER_RULES = (
    Rule("valid_order_id", "order_id IS NOT NULL", drop=True),
    Rule("valid_amount", "order_amount >= 0"),
    Rule("valid_quantity", "quantity > 0"),
)
POS_RULES = (
    Rule("valid_transaction_id", "transaction_id IS NOT NULL", drop=True),
    Rule("valid_amount", "transaction_amount >= 0"),
    Rule("valid_quantity", "quantity > 0"),
)


def drop_violators(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that satisfy every dropping rule; the other rules only count."""
    return reduce(lambda kept, rule: kept.filter(F.expr(rule.predicate)), (r for r in rules if r.drop), df)


def flag_violations(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    names = F.array_compact(F.array(*[F.when(~rule.holds, F.lit(rule.name)) for rule in rules]))
    return df.withColumn("violations", names)


def quarantine(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that break at least one rule, with the names of the broken rules."""
    return flag_violations(df, rules).filter(F.size("violations") > 0)


def violation_figures(rules: Sequence[Rule]) -> dict[str, Column]:
    """Metric expressions by name: the rows, and the violations of each rule."""
    return {"rows": F.count(F.lit(1)), **{rule.name: F.count_if(~rule.holds) for rule in rules}}


def violation_counts(rules: Sequence[Rule]) -> list[Column]:
    """The same, usable in agg() and in observe(), batch or stream."""
    return [metric.alias(name) for name, metric in violation_figures(rules).items()]


def observed(df: DataFrame, rules: Sequence[Rule], name: str) -> tuple[DataFrame, Observation]:
    """The kept rows, with the rule metrics collected by the job that consumes them."""
    watch = Observation(name)
    return drop_violators(df.observe(watch, *violation_counts(rules)), rules), watch


def report(df: DataFrame, rules: Sequence[Rule], dataset: str) -> DataFrame:
    """One row per rule from one pass over the data."""
    counts = df.agg(*violation_counts(rules))
    rows = F.array(
        *[
            F.struct(
                F.lit(dataset).alias("dataset"),
                F.lit(rule.name).alias("rule"),
                F.lit(rule.action).alias("action"),
                F.col("rows").alias("rows_checked"),
                F.col(rule.name).alias("violations"),
            )
            for rule in rules
        ]
    )
    return counts.select(F.inline(rows))


def validity_summary(df: DataFrame, valid: Column) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_rows"), F.count_if(valid).alias("valid_rows")).select(
        "total_rows",
        "valid_rows",
        (F.col("total_rows") - F.col("valid_rows")).alias("invalid_rows"),
        F.when(F.col("total_rows") > 0, F.col("valid_rows") * 100.0 / F.col("total_rows"))
        .otherwise(0.0)
        .alias("valid_pct"),
    )


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(F.col(name).isNull()).alias(f"null_{name}") for name in columns],
    )


def numeric_stats(df: DataFrame, column: str, total: Column) -> DataFrame:
    """min, avg and max of a column; `total` is its exact sum expression."""
    return df.agg(
        F.min(column).cast("double").alias("min_value"),
        total.alias("__total"),
        F.count(column).alias("__n"),
        F.max(column).cast("double").alias("max_value"),
    ).select(
        F.lit(column).alias("column_name"),
        "min_value",
        F.when(F.col("__n") > 0, F.col("__total") / F.col("__n")).alias("avg_value"),
        "max_value",
    )


def row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    counted = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def mask_contacts(df: DataFrame) -> DataFrame:
    """E-mail and phone with all but their last four characters hidden."""
    return df.withColumns({name: mask_tail(F.col(name)) for name in ("email", "phone")})
