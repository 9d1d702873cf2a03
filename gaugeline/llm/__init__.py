"""Operators for preparing text corpora, each a ``DataFrame -> DataFrame`` function."""
