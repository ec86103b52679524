"""Operators of a training-data pipeline: quality rules, near duplicates,
personal data and secrets, language models, tokenising, mixing, web records.

Nothing outside this subpackage imports it.
"""
