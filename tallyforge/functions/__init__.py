"""Column-level helpers made of built-in Spark functions."""
