"""Trained models go to tasks whatever their session did before."""

from pyspark.sql import Observation
from pyspark.sql import functions as F
from retail_helpers import rows

from keepwell.plans import ml
from keepwell.queries import _trained, _training_set


def test_a_model_predicts_in_a_session_that_observed_a_frame(spark, env):
    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get == {"n": 3}
    trained = _trained(env, "logistic_regression")
    assert rows(ml.predict(trained.model, _training_set(env)[1])) == rows(trained.predictions)
