"""Training, choice, importance and deployment share one fitted pipeline."""

import pytest
from retail_helpers import SMALL, rows
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from keepwell import fixed_values as fixed
from keepwell.operators import mlprep
from keepwell.plans import churn, ml
from keepwell.plans.medians import ExactMedianImputer
from keepwell.plans.registry import BadScores, ModelRegistry
from keepwell.queries import QUERIES, Env, _trained, _training_set, features
from keepwell.session import fresh_path, shared_folder
from keepwell.sources.tables import create_database


@pytest.fixture(scope="module")
def wide(spark):
    """Features of the larger folder: enough rows for a meaningful held-out score."""
    return Env(spark, "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def linear(wide):
    return _trained(wide, "logistic_regression")


def metric(trained, split, name):
    return trained.metrics.filter(F.col("split") == split).first()[name]


def test_model_frame_replaces_the_never_purchased_code(spark, wide):
    frame = ml.model_frame(features(wide, "P"))
    row = frame.filter(f"{ml.FLAG} = 1").first()
    assert row.days_since_last_purchase is None and row.preferred_channel == "Unknown"
    assert frame.filter(f"{ml.FLAG} = 0 AND days_since_last_purchase IS NULL").count() == 0


def test_weights_are_balanced(wide):
    _, _, train, count, _ = _training_set(wide)
    total = train.groupBy(fixed.LABEL).agg(F.sum("balanced_weight")).collect()
    assert [pytest.approx(count / 2)] * 2 == [r[1] for r in total]


def test_linear_model_beats_the_majority_on_held_out_rows(linear):
    assert metric(linear, "test", "f1") > 0.6
    assert metric(linear, "test", "roc_auc") > 0.6


def test_rank_auc_equals_the_evaluator(wide, linear):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    _, split, _, _, _ = _training_set(wide)
    scored = linear.model.transform(split.filter("split = 'test'"))
    evaluator = BinaryClassificationEvaluator(labelCol=fixed.LABEL, metricName="areaUnderROC", numBins=0)
    assert evaluator.evaluate(scored) == pytest.approx(metric(linear, "test", "roc_auc"), abs=1e-9)


def test_stored_model_scores_like_the_trained_one(spark, wide, linear):
    _, split, _, _, _ = _training_set(wide)
    loaded = PipelineModel.load(linear.path)
    assert rows(ml.predict(loaded, split)) == rows(ml.predict(linear.model, split))
    # serving rows come without a split and give the same probabilities
    served = ml.predict(linear.model, ml.model_frame(features(wide, "P")))
    columns = ("customer_id", "ml_churn_probability")
    assert rows(served, *columns) == rows(ml.predict(linear.model, split), *columns)


def test_unseen_category_is_scored(wide, linear):
    _, split, _, _, _ = _training_set(wide)
    odd = split.limit(3).withColumn("loyalty_tier", F.lit("Diamond"))
    assert ml.predict(linear.model, odd).filter("ml_churn_probability IS NULL").count() == 0


def test_leaderboard_chooses_on_validation(spark):
    metrics = spark.createDataFrame(
        [("a", "validation", 0.5), ("a", "test", 0.9), ("b", "validation", 0.6), ("b", "test", 0.1)],
        "model string, split string, f1 double",
    ).withColumns({n: F.col("f1") for n in ("accuracy", "precision", "recall", "roc_auc")})
    assert ml.leaderboard(metrics).first().model == "b"


def test_forest_and_importance(spark):
    QUERIES["ml_train_rf"](spark, SMALL)
    env = Env(spark, SMALL)
    ranked = ml.feature_importance(_trained(env, "random_forest").model, _training_set(env)[1], 100).collect()
    assert ranked[-1].cumulative_share == pytest.approx(1.0)
    assert all(a.importance >= b.importance for a, b in zip(ranked, ranked[1:]))
    assert "loyalty_tier=Gold" in {r.feature for r in ranked}


def test_linear_importance_has_direction(wide, linear):
    ranked = ml.feature_importance(linear.model, _training_set(wide)[1])
    assert ranked.count() == 15
    assert {r.direction for r in ranked.collect()} <= {1.0, -1.0}


def test_deployed_scores_are_whole_and_in_range(wide, linear):
    rows_in = features(wide, "P")
    predicted = ml.predict(linear.model, ml.model_frame(rows_in)).select("customer_id", "ml_churn_probability")
    scores = churn.scores_from_probability(rows_in.join(predicted, "customer_id"), F.col("ml_churn_probability"))
    assert scores.columns == list(churn.SCORES)
    row = scores.agg(F.count("churn_score"), F.min("churn_score"), F.max("churn_score")).first()
    assert row[0] == rows_in.count() and 0 <= row[1] <= row[2] <= 100


def test_the_pipeline_fills_with_exact_medians(spark, wide, linear):
    _, _, train, _, prepared = _training_set(wide)
    columns = prepared.stages[0].getInputCols()
    medians = dict(zip(columns, prepared.stages[0].getOrDefault("medians"), strict=True))
    assert medians == mlprep.fitted_medians(train, columns)
    exact = train.agg(*[F.expr(f"percentile(`{c}`, 0.5)").alias(c) for c in columns]).first().asDict()
    assert medians == pytest.approx(exact)
    loaded = PipelineModel.load(linear.path).stages[0]
    assert loaded.getOrDefault("medians") == prepared.stages[0].getOrDefault("medians")


def test_medians_of_odd_columns(spark, tmp_path):
    df = spark.createDataFrame([(1.0, None, 3), (None, None, 4), (float("nan"), None, 5), (2.0, None, None)], "a double, b double, c int")
    pipeline = Pipeline(stages=[ExactMedianImputer(inputCols=["a", "b", "c"], outputCols=["x", "y", "z"])])
    pipeline.write().overwrite().save(str(tmp_path / "pipeline"))
    model = Pipeline.load(str(tmp_path / "pipeline")).fit(df)
    got = rows(model.transform(df), "x", "y", "z")
    assert got == [(1.0, 0.0, 3.0), (1.5, 0.0, 4.0), (1.5, 0.0, 5.0), (2.0, 0.0, 4.0)]


def test_registry_deploys_checked_scores_and_goes_back(spark, tmp_path):
    create_database(spark, "registered")
    registry = ModelRegistry(spark, str(tmp_path), "registered.scores")
    assert registry.current() is None
    first, second, third = (registry.register(m, f"/{m}", {"f1": f}) for m, f in (("a", 0.5), ("b", 0.9), ("c", 0.9)))
    assert (first, registry.best("f1")) == (1, second) and registry.runs().count() == third
    customers = spark.range(20).select(F.col("id").alias("customer_id"))
    scored = lambda n: customers.withColumn("churn_score", F.lit(n))
    assert registry.deploy(first, scored(10), customers) == 1
    assert registry.deploy(second, scored(20), customers) == 2
    assert registry.current() == {"run": second, "version": 2} and {r.churn_score for r in registry.scores().collect()} == {20}
    faulty = {"18 missing": scored(1).limit(2), "1 unknown": scored(1).union(spark.createDataFrame([(99, 5)], "c long, s int")),
              "20 repeated": scored(1).union(scored(1)), "20 out of range": scored(101)}
    for told, scores in faulty.items():
        with pytest.raises(BadScores, match=told):
            registry.deploy(third, scores, customers)
        assert registry.current()["run"] == second and {r.churn_score for r in registry.scores().collect()} == {20}
    with pytest.raises(Exception):
        registry.deploy(17, scored(1), customers)
    assert registry.roll_back() == {"run": first, "version": 1}
    assert {r.churn_score for r in registry.scores().collect()} == {10}
    with pytest.raises(LookupError):
        registry.roll_back()


def test_deployed_scores_come_from_the_registry(spark):
    runs = QUERIES["deploy_runs"](spark, SMALL).collect()
    assert len(runs) == len(ml.CANDIDATES) and sum(r.deployed_version is not None for r in runs) == 1
    best = max(runs, key=lambda r: (r.metrics["validation_f1"], -r.run))
    assert best.deployed_version == 1
    deployed = QUERIES["deploy_scores_trained"](spark, SMALL)
    assert deployed.count() == 150 and deployed.inputFiles()
    sources = {r.score_source: r["count"] for r in QUERIES["current_scores_trained"](spark, SMALL).groupBy("score_source").count().collect()}
    assert set(sources) == {"model", "rule"} and sum(sources.values()) == 150


def test_shared_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert fresh_path(spark, "x").startswith(shared_folder(spark))
