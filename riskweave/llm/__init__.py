"""Operators of a training-data pipeline (one module per operator).

Nothing outside this subpackage imports it; ``queries.py`` registers one query
per operator and ``corpus_pipeline.py`` (repository top) chains five of them.
"""
