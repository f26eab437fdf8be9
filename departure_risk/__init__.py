"""Day-ahead departure-delay risk as Spark DataFrame operators."""
