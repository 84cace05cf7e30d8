"""Preparing a product catalogue and searching it by similarity, on Spark."""
