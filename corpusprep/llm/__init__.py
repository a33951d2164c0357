"""Operators for training-data pipelines (deduplication, language, decontamination, mixing, extraction).

Nothing else in the library imports this subpackage; its queries are registered by
``llm/queries.py`` and its tests are in ``tests/llm``.
"""
