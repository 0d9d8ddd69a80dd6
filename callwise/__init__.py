"""Campaign propensity work on Spark: profile, check, prepare, train, evaluate and score customer tables."""
