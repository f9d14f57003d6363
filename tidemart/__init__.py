"""Layered retail analytics on Spark: raw documents -> clean daily rows -> daily aggregates."""
