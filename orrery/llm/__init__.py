"""Operators of a training-data pipeline: quality, toxicity, near duplicates, decontamination, mixing, output."""
