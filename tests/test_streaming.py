"""Streams take each file once, survive a restart and agree with the batch result."""

import pytest
from retail_helpers import rows
from pyspark.sql import functions as F

from keepwell.operators import quality
from keepwell.plans import silver
from keepwell.sources.files import SharedFiles
from keepwell.streaming import ingest
from keepwell.streaming.refresh import refresh
from keepwell.streaming.schemas import wider


@pytest.fixture
def folders(tmp_path):
    return {name: str(tmp_path / name) for name in ("landing", "bronze", "silver", "schema", "cb", "cs")}


def run(spark, folders, files_per_batch=1):
    schema = ingest.LANDING["orders"]
    first = ingest.ingest(spark, folders["landing"], folders["bronze"], folders["cb"], schema, files_per_batch)
    second = ingest.refine(spark, "orders", folders["bronze"], folders["silver"], folders["cs"], files_per_batch)
    return first, second


def stored(sink, folder="_figures"):
    return len(sink.files.names(f"{sink.base}/{folder}"))


def test_restart_reads_only_new_files_and_equals_batch(spark, env, folders):
    orders = env.inputs.dirty_orders().orderBy("order_amount", "order_id")
    early, late = orders.filter("quantity <= 25"), orders.filter("quantity > 25")
    ingest.write_landing(early, folders["landing"], 4)
    bronze, silver_table = run(spark, folders)
    assert stored(bronze) == 4
    assert bronze.totals() == {"rows": early.count(), "rescued": 0}

    ingest.write_landing(late, folders["landing"], 1)
    run(spark, folders)
    assert stored(bronze) == 5 and bronze.totals()["rows"] == orders.count()
    run(spark, folders)
    assert stored(bronze) == 5  # nothing new

    batch = silver.silver_p("orders", env.inputs.dirty_orders())
    streamed = silver_table.read()
    assert streamed.schema.simpleString() == batch.schema.simpleString()
    assert rows(streamed) == rows(batch)
    report = quality.report(silver.project_orders_p(env.inputs.dirty_orders()), quality.ORDER_RULES, "orders")
    assert {r.rule: r.violations for r in report.collect()} == {k: v for k, v in silver_table.totals().items() if k != "rows"}


def test_nothing_that_lands_is_lost(spark, folders):
    """A rare field, a late fractional value, a late new column and text ids are typed; what fits nothing is kept as it is."""
    schema = "id bigint, amount bigint, note string, day date"

    def land():
        bronze = ingest.ingest(spark, folders["landing"], folders["bronze"], folders["cb"], schema, limits={"amount": "double"})
        return bronze, bronze.read()

    plain = spark.range(1, 2000).selectExpr("id", "id * 2 AS amount", "date'2020-01-01' AS day")
    rare = spark.range(2000, 2001).selectExpr("id", "id * 2 AS amount", "'rare' AS note")
    ingest.write_landing(plain.unionByName(rare, allowMissingColumns=True), folders["landing"])
    bronze, first = land()
    assert dict(first.dtypes)["amount"] == "bigint" and bronze.totals() == {"rows": 2000, "rescued": 0}
    assert rows(first.filter("note is not null"), "id", "note") == [(2000, "rare")]

    ingest.write_landing(spark.range(3000, 3001).selectExpr("id", "1.5 AS amount"), folders["landing"])
    ingest.write_landing(spark.range(3001, 3002).selectExpr("id", "4 AS amount", "7 AS extra"), folders["landing"])
    _, second = land()
    assert {"amount": "double", "extra": "bigint", "id": "bigint"}.items() <= dict(second.dtypes).items()
    assert second.count() == 2002 and bronze.totals()["rescued"] == 0
    assert rows(second.filter("id >= 3000"), "id", "amount", "extra") == [(3000, 1.5, None), (3001, 4.0, 7)]

    lines = ['{"id": "C0007", "amount": 2.5, "extra": true}', '{"id": 5000, "amount": "much"}', '{"id": 3002, "amount', "[1]",
             '{"id": 5001, "day": "someday"}']
    spark.createDataFrame([(line,) for line in lines], "value string").write.mode("append").text(folders["landing"])
    _, third = land()
    assert {"id": "string", "amount": "double", "extra": "string", "day": "date"}.items() <= dict(third.dtypes).items()
    assert rows(third.filter("id in ('1', 'C0007', '3001')"), "id", "amount", "extra") == [
        ("1", 2.0, None), ("3001", 4.0, "7"), ("C0007", 2.5, "true"),
    ]
    assert third.count() == 2007 and bronze.totals() == {"rows": 2007, "rescued": 4}
    assert {r[0] for r in third.filter(f"{ingest.RESCUED} is not null").select(ingest.RESCUED).collect()} == set(lines[1:])


def test_types_only_widen():
    assert [wider(a, b) for a, b in (("bigint", "double"), ("double", "bigint"), ("bigint", "string"), ("date", "timestamp_ntz"),
                                     ("boolean", "bigint"), ("void", "date"), ("string", "void"))] == [
        "double", "double", "string", "timestamp_ntz", "string", "date", "string",
    ]


class Crash(Exception):
    pass


@pytest.mark.parametrize("step", ["rename", "write_new"])
def test_a_stopped_driver_reports_the_same_totals(spark, env, folders, monkeypatch, step):
    """The driver dies before a batch takes its place, or before its figures are noted; the next run makes up for it."""
    orders = env.inputs.dirty_orders()
    ingest.write_landing(orders, folders["landing"], 3)
    whole = SharedFiles.rename if step == "rename" else SharedFiles.write_new
    calls = []

    def crash(self, *args):
        if step == "rename" or "_figures" in args[0]:
            calls.append(args)
            if len(calls) == 2:
                raise Crash
        return whole(self, *args)

    with monkeypatch.context() as patched, pytest.raises(Exception, match="Crash"):
        patched.setattr(SharedFiles, step, crash)
        run(spark, folders)
    bronze, silver_table = run(spark, folders)
    assert bronze.totals() == {"rows": orders.count(), "rescued": 0}
    assert rows(bronze.read().select(orders.columns), "order_id") == rows(orders, "order_id")
    assert rows(silver_table.read()) == rows(silver.silver_p("orders", orders))
    report = quality.report(silver.project_orders_p(orders), quality.ORDER_RULES, "orders")
    assert {r.rule: r.violations for r in report.collect()} == {k: v for k, v in silver_table.totals().items() if k != "rows"}


def test_a_repeated_key_in_a_later_file_does_not_reach_silver(spark, env, folders):
    """Keys are remembered until the watermark passes them; rows behind the watermark are left out."""
    unique = ingest.Unique("order_id", "order_date", "30 days")
    base = env.inputs.orders().limit(1).drop("order_id", "order_date")

    def land(*sold):
        arrived = spark.createDataFrame(sold, "order_id string, day string").withColumn("order_date", F.expr("CAST(day AS timestamp_ntz)"))
        ingest.write_landing(arrived.drop("day").crossJoin(F.broadcast(base)), folders["landing"], 1)
        ingest.ingest(spark, folders["landing"], folders["bronze"], folders["cb"], ingest.LANDING["orders"])
        kept = ingest.refine(spark, "orders", folders["bronze"], folders["silver"], folders["cs"], unique=unique)
        return sorted(r.order_id for r in kept.read().collect())

    assert land(("a", "2020-01-01"), ("a", "2020-01-01"), ("b", "2020-01-02")) == ["a", "b"]
    assert land(("a", "2020-01-01"), ("c", "2020-01-03")) == ["a", "b", "c"]
    assert land(("d", "2020-06-01")) == ["a", "b", "c", "d"]  # the watermark moves to May
    # behind the watermark: the new key does not pass; in front of it the forgotten key passes again
    assert land(("late", "2020-01-05"), ("a", "2020-06-02"), ("d", "2020-06-03")) == ["a", "a", "b", "c", "d"]


def test_reference_shaped_ids_reach_gold(spark, env, tmp_path):
    """Text ids in four datasets, numbers in one: profiles are whole, and what was rescued is reported."""
    text = lambda c: F.concat(F.lit("CUST"), F.lpad(F.col(c).cast("string"), 6, "0"))
    sources = {
        "products": env.inputs.products(),
        "customers": env.inputs.customers().withColumn("customer_id", text("customer_id")),
        "loyalty": env.inputs.loyalty().withColumn("customer_id", text("customer_id")),
        "orders": env.inputs.orders().withColumn("customer_id", text("customer_id")).withColumn("product_id", F.col("product_id").cast("string")),
        "pos": env.inputs.pos().withColumn("customer_id", text("customer_id")),
    }
    landing = {name: str(tmp_path / "landing" / name) for name in sources}
    for name, df in sources.items():
        ingest.write_landing(df, landing[name])
    tables = refresh(spark, landing, str(tmp_path / "tables"), "text_ids_gold", env.as_of)
    expected = env.c360_p.withColumn("customer_id", text("customer_id"))
    assert rows(tables["gold_customer_360"]) == rows(expected)
    report = {r.dataset: (r.rows, r.rescued) for r in tables.landing_report().collect()}
    assert report == {name: (df.count(), 0) for name, df in sources.items()}


def test_rows_after_the_as_of_day_are_kept(spark, env):
    late = env.inputs.table("lineitem").filter("l_shipdate >= '2001-08-02'").count()
    kept = env.transactions.filter("transaction_timestamp >= '2001-08-02'").count()
    assert 0 < kept <= late
    assert env.kpis.filter("metric_date >= '2001-08-02'").count() > 0


def test_triggered_refresh_continues_and_rebuilds_gold(spark, env, tmp_path):
    """Two refreshes on the same base: the second takes the late files and gold equals the batch result."""
    sources = {
        "products": env.inputs.products(), "customers": env.inputs.customers(), "loyalty": env.inputs.loyalty(),
        "orders": env.inputs.orders(), "pos": env.inputs.pos(),
    }
    landing = {name: str(tmp_path / "landing" / name) for name in sources}
    late = {name: F.pmod(F.xxhash64(*df.columns), F.lit(3)) == 0 for name, df in sources.items()}
    for arrived in (False, True):
        for name, df in sources.items():
            ingest.write_landing(df.filter(late[name] == F.lit(arrived)), landing[name])
        tables = refresh(spark, landing, str(tmp_path / "tables"), "streamed_gold", env.as_of)
    assert rows(tables["gold_customer_360"]) == rows(env.c360_p)
    assert rows(tables["gold_customer_churn_scores"]) == rows(env.scores_p)
