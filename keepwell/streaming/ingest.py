"""Incremental ingestion: landing JSON -> bronze -> silver, each file once.

Both hops are append-only file streams with their own checkpoint, run with
availableNow: a run takes what has arrived since the last one and stops. Each
micro-batch is stored once, together with the figures counted over it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType, StructField, StructType

from keepwell.operators.quality import Rule, drop_violators, violation_figures
from keepwell.plans.silver import SILVER_P
from keepwell.session import shuffles_freed
from keepwell.streaming.schemas import SchemaLog, fields_of
from keepwell.streaming.sink import BatchSink


# Compressed lines are read by one task a file, so a file holds so many rows at most.
LANDING_ROWS = 1_000_000


def write_landing(df: DataFrame, folder: str, files: int | None = None) -> None:
    """Rows as compressed JSON files in a landing folder, added to what is there; one file per task unless a count is given."""
    spread = df if files is None else df.repartition(files)
    with shuffles_freed(df.sparkSession):
        spread.write.mode("append").options(compression="gzip", maxRecordsPerFile=LANDING_ROWS).json(folder)


# Declared columns of the landing files, by dataset. What does not fit goes to the rescue column.
LANDING = {
    "products": "product_id bigint, product_name string, category string, brand string, price double",
    "customers": "customer_id bigint, first_name string, last_name string, email string, phone string, "
    "registration_date date, city string, state string, country string",
    "loyalty": "customer_id bigint, loyalty_tier string, points_balance bigint, member_since date, status string",
    "orders": "order_id string, customer_id bigint, product_id bigint, order_date timestamp_ntz, quantity bigint, "
    "order_amount double, order_status string, channel string, payment_method string",
    "pos": "transaction_id string, customer_id bigint, product_id bigint, transaction_date timestamp_ntz, "
    "quantity bigint, transaction_amount double, transaction_status string, channel string, store_id string, "
    "store_name string, store_city string, store_state string, payment_method string",
}
RESCUED = "_rescued"


def parsed(lines: DataFrame, schema: StructType | str, more_fields: bool = True) -> DataFrame:
    """Landing lines (`value`) as declared columns and the rescue column.

    more_fields: off where every line is known to hold declared fields only; the lines are then parsed once, not twice.

    A line that is no JSON object, or holds a value that its column's type cannot, is rescued whole; fields
    that are not declared are rescued as an object of their own. Nothing else is lost either: every line
    gives a row, and declared fields of the right type keep their values.
    """
    declared = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    held = StructType([*declared.fields, StructField("_broken", StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}
    rows = lines.select("value", F.from_json("value", held, options).alias("row"))
    rescued = F.when(F.col("row").isNull() | F.col("row._broken").isNotNull(), F.col("value"))
    if more_fields:
        names = F.array(*[F.lit(name) for name in declared.names])
        fields = F.from_json("value", MapType(StringType(), StringType()), {"mode": "PERMISSIVE"})
        rows = rows.withColumn("more", F.map_filter(fields, lambda name, _: ~F.array_contains(names, name)))
        rescued = rescued.when(F.size("more") > 0, F.to_json("more"))
    return rows.select(*[F.col(f"row.`{name}`").alias(name) for name in declared.names], rescued.alias(RESCUED))


def rescued_rows(bronze: DataFrame) -> DataFrame:
    """How many rows of a bronze table hold something rescued."""
    return bronze.agg(F.count(F.lit(1)).alias("row_count"), F.count(RESCUED).alias("rescued_count"))


# The widest types that declared columns may take. Ids may turn out to be text; amounts and quantities may
# turn out to be fractions, and text among them is a fault of the row.
LIMITS = {"price": "double", "points_balance": "double", "quantity": "double", "order_amount": "double", "transaction_amount": "double"}


def _run(stream: DataFrame, checkpoint: str, name: str, take: Callable[[DataFrame, int], None]) -> None:
    """Hand over what has arrived since the last run in micro-batches, then stop."""
    query = (
        stream.writeStream.queryName(name)
        .foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def ingest(
    spark: SparkSession,
    landing: str,
    target: str,
    checkpoint: str,
    schema: StructType | str,
    files_per_batch: int = 1000,
    name: str = "bronze",
    limits: Mapping[str, str] | None = None,
) -> BatchSink:
    """Append every landing file not seen yet to the bronze table.

    Before a batch is parsed, the types of its values are looked up, and the schema is widened where they
    do not fit: an id that is text, a fractional amount, a new field. So only broken lines, and text where a
    number or date is due, are rescued.
    """
    declared = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    sink = BatchSink(spark, target)
    schemas = SchemaLog(spark, f"{target}/_schemas", declared)

    def take(lines: DataFrame, batch: int) -> None:
        kinds, whole = fields_of(lines)
        _, current = schemas.evolve(kinds, LIMITS if limits is None else limits)
        rows = parsed(lines, current, not whole or not set(kinds) <= set(current.names))
        sink.write(rows, f"b{batch:09d}", {"rows": F.count(F.lit(1)), "rescued": F.count(RESCUED)})

    _run(spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(landing), checkpoint, name, take)
    return sink


@dataclass(frozen=True)
class Unique:
    """One row per key: a repeated key within the delay of the latest time does not pass, later rows do not either."""

    key: str
    time: str
    delay: str


def refine(
    spark: SparkSession,
    dataset: str,
    bronze: str,
    target: str,
    checkpoint: str,
    files_per_batch: int = 1000,
    unique: Unique | None = None,
) -> BatchSink:
    """Append new bronze rows to silver: project, count rule violations, drop violators.

    Bronze batches of one schema are one stream. With `unique`, keys are remembered in the stream's state as
    long as the watermark, `delay` behind the latest time, has not passed them.
    """
    project, rules = SILVER_P[dataset]
    sink = BatchSink(spark, target)
    figures = violation_figures(rules)

    def prepared(rows: DataFrame) -> DataFrame:
        rows = project(rows)
        if not unique:
            return rows
        timed = rows.withColumn("_time", F.col(unique.time).cast("timestamp")).withWatermark("_time", unique.delay)
        return timed.dropDuplicatesWithinWatermark([unique.key]).drop("_time")

    def take(rows: DataFrame, name: str) -> None:
        sink.write(rows, name, figures, lambda df: drop_violators(df, rules))

    each_batch(BatchSink(spark, bronze), checkpoint, f"silver_{dataset}", take, files_per_batch, prepared)
    return sink


def each_batch(
    upstream: BatchSink,
    checkpoint: str,
    name: str,
    take: Callable[[DataFrame, str], None],
    files_per_batch: int = 1000,
    prepared: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> None:
    """Hand over what was stored upstream since the last run, in named micro-batches; each schema is a stream."""
    for group, schema in upstream.schemas().items():
        reader = upstream.spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
        rows = reader.option("recursiveFileLookup", "true").parquet(f"{upstream.base}/data/{group}")
        _run(prepared(rows), f"{checkpoint}/{group}", name, lambda df, batch, group=group: take(df, f"{group}-b{batch:09d}"))


def violation_rows(spark: SparkSession, dataset: str, totals: Mapping[str, int], rules: tuple[Rule, ...]) -> DataFrame:
    rows = [(dataset, r.name, r.action, totals.get("rows", 0), totals.get(r.name, 0)) for r in rules]
    return spark.createDataFrame(
        rows, "dataset string, rule string, action string, rows_checked long, violations long"
    )
