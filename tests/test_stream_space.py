"""Streams keep on disk what is read again: not the lines, the landed files and the shuffles that are done with."""

import time

import pytest
from pyspark.sql import functions as F
from retail_helpers import SMALL, rows

from keepwell import queries
from keepwell.session import shuffles_freed
from keepwell.sources.files import SharedFiles
from keepwell.streaming import ingest
from keepwell.streaming.incremental import CustomerState, choices_of_orders, days_of_orders
from keepwell.streaming.sink import BatchSink

DATASETS = ("products", "customers", "loyalty", "orders", "pos")


def shuffled(spark):
    """Names of the shuffle files that lie on disk."""
    kept = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (kept.apply(i).getName() for i in range(kept.size()))
    return {name for name in names if name.startswith("shuffle_")}


def left_behind(spark, before, seconds=20):
    """The shuffle files that are still there when Spark had time to remove them."""
    until = time.time() + seconds
    while (new := shuffled(spark) - before) and time.time() < until:
        time.sleep(0.2)
    return new


def test_landed_files_are_compressed_and_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ingest, "LANDING_ROWS", 400)
    df = spark.range(1000).selectExpr("CAST(id AS string) AS order_id", "id AS quantity", "'Ecommerce' AS channel")
    landing = str(tmp_path / "landing")
    ingest.write_landing(df, landing, 1)
    df.coalesce(1).write.json(str(tmp_path / "plain"))
    size = lambda folder: sum(p.stat().st_size for p in (tmp_path / folder).glob("part-*"))
    assert size("landing") * 3 < size("plain")
    assert sorted(spark.read.text(str(p)).count() for p in (tmp_path / "landing").glob("part-*")) == [200, 400, 400]
    sink = ingest.ingest(spark, landing, str(tmp_path / "bronze"), str(tmp_path / "checkpoint"), ingest.LANDING["orders"])
    assert sink.totals() == {"rows": 1000, "rescued": 0}
    assert rows(sink.read().select(df.columns)) == rows(df)


def test_a_write_frees_its_shuffles(spark, env, tmp_path):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = shuffled(spark)
    kept = env.inputs.stored(str(tmp_path / "lines"))
    ingest.write_landing(kept.orders(), str(tmp_path / "landing"), 3)
    sink = BatchSink(spark, str(tmp_path / "table"))
    sink.write(kept.orders().groupBy("customer_id").count(), "b1", {"rows": F.count(F.lit(1))})
    assert not left_behind(spark, before)
    assert sink.read().count() == kept.orders().select("customer_id").distinct().count()
    for held in (None, "true", "false"):
        spark.conf.unset(setting) if held is None else spark.conf.set(setting, held)
        with pytest.raises(ValueError), shuffles_freed(spark):
            assert spark.conf.get(setting) == "true"
            raise ValueError
        assert spark.conf.get(setting, None) == held
    spark.conf.unset(setting)


def test_a_frame_runs_again_after_its_shuffles_went(spark, tmp_path):
    """A frame that was written is still whole when its rows are wanted once more."""
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    with shuffles_freed(spark):
        first = rows(df)
        df.write.parquet(str(tmp_path / "out"))
    assert rows(df) == first == rows(spark.read.parquet(str(tmp_path / "out")))


@pytest.fixture
def base(tmp_path, monkeypatch):
    """Where a query puts its files; one folder for each name it asks for."""
    monkeypatch.setattr(queries, "fresh_path", lambda spark, name: str(tmp_path / name))
    return tmp_path


def landed(env, dirty=False):
    frames = {name: getattr(env.inputs, name)() for name in DATASETS}
    return {**frames, "orders": env.inputs.dirty_orders()} if dirty else frames


def check_left(spark, at, lines, sources):
    """Landed files and lines are gone; bronze and silver hold every row."""
    assert not SharedFiles(spark).names(f"{at}/landing") and not SharedFiles(spark).exists(str(lines))
    for name, df in sources.items():
        bronze, silver_table = (BatchSink(spark, f"{at}/tables/{name}/{hop}") for hop in ("bronze", "silver"))
        assert bronze.read().count() == df.count() == bronze.totals()["rows"] == silver_table.totals()["rows"]
        assert silver_table.read().count() > 0


def test_incremental_gold_keeps_state_and_tables_only(spark, env, base):
    result = queries.QUERIES["incremental_gold_360_p"](spark, SMALL)
    check_left(spark, base / "incremental", base / "incremental" / "lines", landed(env))
    assert rows(result) == rows(env.c360_p.select(result.columns))


def test_rollup_does_not_merge_keys_before_it_sums(spark, env, tmp_path):
    """One customer's rows of a key in two batches and a fold, with unknown days, products and amounts among them."""
    state = CustomerState(spark, str(tmp_path / "state"))
    day = "timestamp_ntz'2001-07-30 10:00:00'"
    sold = spark.sql(f"""SELECT * FROM VALUES
        (1, 10, 'Completed', 'Ecommerce', {day}, 5.0), (1, 10, 'Completed', 'Ecommerce', {day}, 7.0),
        (1, NULL, 'Completed', NULL, {day}, NULL), (1, 11, 'Returned', 'Ecommerce', {day}, 1.0),
        (2, 11, 'Completed', 'Ecommerce', CAST(NULL AS timestamp_ntz), 2.0)
        AS t(customer_id, product_id, order_status, channel, order_date, order_amount)""")  # fmt: skip
    def take(name):
        for part, reduced in (("days", days_of_orders), ("choices", choices_of_orders)):
            state.parts[part].write(sold, name, {"rows": F.count(F.lit(1))}, reduced)

    products = spark.sql("SELECT * FROM VALUES (10, 'a'), (11, 'b') AS t(product_id, category)")
    for name in ("one", "two"):
        take(name)
    unfolded = rows(state.rollup(products, env.as_of))
    state.compact()
    assert rows(state.rollup(products, env.as_of)) == unfolded
    take("three")
    rollup = state.rollup(products, env.as_of)
    plan = rollup._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(customer_id" in plan
    assert not [line for line in plan.splitlines() if "Exchange" in line and (", day" in line or ", product_id" in line)]
    got = {r.customer_id: r.asDict() for r in rollup.collect()}
    assert {k: got[1][k] for k in ("ecom_orders", "ecom_cents", "refund_return_count", "least_age", "transactions_last_30d",
                                   "favorite_category", "preferred_channel")} == {
        "ecom_orders": 9, "ecom_cents": 3600, "refund_return_count": 3, "least_age": 2, "transactions_last_30d": 9,
        "favorite_category": "a", "preferred_channel": "Ecommerce",
    }
    assert (got[2]["ecom_orders"], got[2]["least_age"], got[2]["transactions_last_30d"]) == (3, None, 0)


def test_streamed_gold_keeps_its_tables_only(spark, env, base):
    result = queries.QUERIES["streamed_gold_360_p"](spark, SMALL)
    check_left(spark, base / "stream", base / "lines", landed(env))
    assert rows(result) == rows(env.c360_p.select(result.columns))


def test_stream_quality_keeps_its_tables_only(spark, env, base):
    report = rows(queries.QUERIES["stream_quality_report"](spark, SMALL))
    check_left(spark, base / "stream", base / "lines", landed(env, dirty=True))
    assert report == rows(queries.QUERIES["dq_expectation_report"](spark, SMALL))
