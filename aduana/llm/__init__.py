"""Operators for training-data corpora: dedup, mixing, extraction, scoring and decontamination.

Nothing else in the library imports this subpackage.
"""
