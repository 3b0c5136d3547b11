"""Column helpers: each returns a Column built from Spark's own functions."""
