"""Operators for preparing training data: one module per operator, plain DataFrames in and out.

``queries`` holds the thin query of each operator over the test tables. Nothing
outside this package imports it.
"""
