"""Operators for large-scale training-data preparation.

Nothing else in the package imports this subpackage; it may be removed as a
whole without touching the storm-track engine.
"""
