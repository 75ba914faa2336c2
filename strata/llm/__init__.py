"""Operators of a training-data pipeline: dedup, mixing, filters, packing, extraction, search.

Nothing else in the package imports this subpackage; its queries are listed in
``strata.llm.registry``.
"""
