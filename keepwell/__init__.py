"""Customer retention analytics on Spark: conform, profile, score, act, serve."""
