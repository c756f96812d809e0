"""Operators of a training-data pipeline: search, language, duplicates, mixing, scans, scoring, token files."""
