"""Operators of a training-data pipeline on Spark DataFrames.

One module per operator; ``queries`` registers one query per operator.
Nothing else in the library imports this subpackage.
"""
