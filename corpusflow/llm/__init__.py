"""Operators for training-data pipelines: one module per operator, their queries in ``q_llm.py``.

Nothing else in the library imports this package; it imports general helpers from the library.
"""
