"""Operators for preparing language-model training data, each a Spark job over a table of texts.

Nothing outside this package imports it.
"""
