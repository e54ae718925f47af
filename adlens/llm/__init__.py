"""Operators for training-data pipelines, one module per operator.

Nothing else in the library imports this subpackage. ``queries.py`` registers
one contract query per operator (``opN_<name>``) and the corpus pipeline.
"""
