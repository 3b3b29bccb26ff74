"""Market-risk analytics as plain Spark DataFrame functions."""
