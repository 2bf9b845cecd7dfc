"""Operators for large-scale training-data pipelines.

Each module holds one operator; ``queries`` registers one query per operator.
Nothing outside this subpackage imports it.
"""
