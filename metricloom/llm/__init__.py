"""Operators of a training-data pipeline: cleaning, counting, mixing, linking and searching texts.

Nothing else in the library imports this subpackage.
"""
