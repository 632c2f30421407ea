"""Operators for training-data pipelines (one module per operator).

Nothing outside this package imports it; ``queries.py`` registers the
``opN_<name>`` queries.
"""
