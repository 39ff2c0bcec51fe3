"""Operators of a training-data pipeline (quality, deduplication, secrets,
licences, decontamination, token statistics and packing).

Each module holds one operator with its general interface; ``queries``
registers the thin ``opN_...`` queries over the given tables.
"""
