"""Operators of a training-data pipeline: filters, searches, dedup and packing over documents."""
