"""Batch, streaming and machine-learning data jobs built from Spark DataFrame operators."""
