"""Operators of a training-data pipeline (quality, de-duplication, packing, mixing, privacy)."""
