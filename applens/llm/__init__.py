"""Training-data operators on Spark: one module per operator, queries in `registry`."""
