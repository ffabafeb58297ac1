"""Operators of a training-data pipeline: filtering, scoring, de-duplication, mixing, packing, search."""
