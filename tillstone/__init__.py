"""Layered retail analytics on Spark: raw files to bronze, silver, gold and a quantity model."""
