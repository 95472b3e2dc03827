"""Operators for preparing training text: quality, deduplication, decontamination, toxicity,
extraction, sharding, packing and token counts.

``queries.py`` registers one query per operator.  Nothing outside this package imports it.
"""
