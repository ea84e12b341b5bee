"""Operators of a training-data pipeline, each one a function over DataFrames.

Nothing else in the library imports this subpackage. ``queries`` registers one
``opN_`` query per operator; ``corpus_pipeline.py`` at the repository top chains
five of them.
"""
