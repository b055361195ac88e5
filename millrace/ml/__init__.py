"""Feature, estimator, evaluation, selection and recommendation steps on pyspark.ml."""
