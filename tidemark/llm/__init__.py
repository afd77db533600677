"""Operators of a training-data pipeline: quality, mixing, tokenising, personal data, near duplicates, licences, URLs."""
