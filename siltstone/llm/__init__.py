"""Operators of a training-data pipeline: filters, scoring, deduplication, tokenisation.

Each module holds one operator over DataFrames; `queries` applies them to whole tables. Functions
that run in Python workers are found by import, so the package must be installed or on the Python
path of the executors.
"""
