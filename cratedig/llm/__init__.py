"""Operators for large-scale training-data pipelines, one module each.

``queries.py`` applies every operator to its whole table with production
parameters; nothing else in the library imports this subpackage.
"""
