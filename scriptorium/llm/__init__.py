"""Operators for large training-data pipelines.

Self-contained: nothing outside this folder imports it, and it can be removed.
"""
