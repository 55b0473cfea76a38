"""Operators of a large-scale training-data pipeline, one module each.

Nothing else in the library imports this subpackage.  ``catalog`` holds
the named queries; :mod:`corpus_pipeline` (repository top) chains five of
the operators.
"""
