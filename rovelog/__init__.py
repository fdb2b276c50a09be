"""Fleet event analytics as Spark DataFrame functions."""
