"""What several results are computed from is computed and stored once."""

import re

from retail_helpers import SMALL, rows
from pyspark.sql import functions as F

from keepwell.operators.dedup import keep_one
from keepwell.plans import customer360, kpis, ml
from keepwell.queries import Env, _best, _trained, _training_set
from keepwell.streaming import ingest
from keepwell.streaming.schemas import fields_of

LINES = "order_id string, quantity bigint"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_profile_and_daily_figures_scan_the_stored_facts(env, tmp_path):
    facts = env.stored_facts(str(tmp_path / "facts"))
    assert rows(facts) == rows(env.transactions.select(*customer360.FACTS))
    rollup = customer360.transaction_rollup_n(facts, None, env.as_of)
    for df in (rollup, kpis.daily_partials(facts)):
        assert "Window" not in plan(df) and "Join" not in plan(df)


def test_orders_and_sales_scan_the_stored_lines(env, tmp_path):
    inputs = env.inputs.stored(str(tmp_path / "lines"))
    for name in ("orders", "dirty_orders", "pos"):
        again, first = getattr(inputs, name)(), getattr(env.inputs, name)()
        assert again.schema == first.schema and rows(again) == rows(first)
        assert "Exchange" not in plan(again)


def test_lines_move_once_for_dedup_and_buyers(spark, env):
    """The join with the orders takes the deduplicated lines where they lie; crowded orders alone move twice."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        moved = re.findall(r"Exchange hashpartitioning\(l_orderkey#\d+L?(, l_linenumber)?.*?\), (\w+)", plan(env.inputs.orders()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    lines, buyers, crowded = ("", "REPARTITION_BY_COL"), ("", "ENSURE_REQUIREMENTS"), (", l_linenumber", "ENSURE_REQUIREMENTS")
    assert sorted(moved) == sorted([lines, buyers, crowded, buyers, buyers])


def test_lines_and_flags_are_those_of_one_dedup_and_join(env):
    lines = keep_one(
        env.inputs.table("lineitem"),
        ["l_orderkey", "l_linenumber"],
        [F.desc("l_shipdate"), "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"],
    )
    paired = lines.join(env.inputs.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    cancelled = (F.col("l_returnflag") == "A") & (F.col("l_linenumber") == 7)
    for frame, flag, key, returned in (("orders", "O", "order", "Returned"), ("pos", "F", "transaction", "Refunded")):
        status = F.when(F.col("l_returnflag") == "R", returned).when(cancelled, "Cancelled").otherwise("Completed")
        expected = paired.filter(F.col("l_linestatus") == flag).select(
            F.concat_ws("-", "l_orderkey", "l_linenumber"), "l_partkey", "l_shipdate", "l_extendedprice", status
        )
        got = getattr(env.inputs, frame)()
        assert rows(got, f"{key}_id", "product_id", f"{key}_date", f"{key}_amount", f"{key}_status") == rows(expected)


def test_stored_lines_keep_rows_without_keys(spark, tmp_path):
    folder = str(tmp_path / "tables")
    for name in ("lineitem", "orders"):
        df = spark.read.parquet(f"{SMALL}/{name}.parquet").limit(50)
        key = "l_partkey" if name == "lineitem" else "o_custkey"
        df.withColumn(key, F.lit(None).cast("long")).unionByName(df).unionByName(df).write.parquet(f"{folder}/{name}.parquet")
    inputs = Env(spark, folder).inputs
    kept = inputs.stored(str(tmp_path / "lines"))
    assert rows(kept.orders()) == rows(inputs.orders()) and rows(kept.pos()) == rows(inputs.pos())


def test_lines_of_declared_fields_are_parsed_once(spark):
    lines = lambda *texts: spark.createDataFrame([(t,) for t in texts], "value string")
    good = lines('{"order_id":"a","quantity":1}', '{"order_id":"b"}')
    kinds, whole = fields_of(good)
    assert whole and kinds == {"order_id": {"string"}, "quantity": {"bigint"}}
    once = ingest.parsed(good, LINES, more_fields=False)
    assert plan(once).count("from_json") < plan(ingest.parsed(good, LINES)).count("from_json")
    assert rows(once) == rows(ingest.parsed(good, LINES))
    for odd in ("no json", "", "[1]", "{}", '"text"', '{"a":1'):
        assert not fields_of(good.union(lines(odd)))[1]


def test_fields_without_a_type_are_still_rescued(spark, tmp_path):
    landing = str(tmp_path / "landing")
    texts = ['{"order_id":"a","quantity":1,"later":null}', '{"order_id":"b","quantity":2}', "{'order_id':'c','odd':'x'}"]
    spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1).write.text(landing)
    sink = ingest.ingest(spark, landing, str(tmp_path / "bronze"), str(tmp_path / "checkpoint"), LINES)
    got = {r.order_id: r[ingest.RESCUED] for r in sink.read().collect()}
    assert got == {"a": '{"later":null}', "b": None, "c": '{"odd":"x"}'}


def test_predictions_and_measures_are_stored_by_the_training(spark, env):
    trained = _trained(env, "logistic_regression")
    split = _training_set(env)[1]
    assert trained.predictions.inputFiles() != split.inputFiles() and trained.metrics.inputFiles() != split.inputFiles()
    assert rows(trained.predictions) == rows(ml.predict(trained.model, split))
    assert rows(trained.metrics) == rows(ml.evaluate(trained.predictions, trained.name))
    assert _best(env).predictions.count() == split.count()
