"""Operators of a training-data pipeline: de-duplication, counting, scoring, scanning and packing.

Nothing outside this subpackage imports it; the queries are registered from :mod:`helixloom.llm.queries`.
"""
