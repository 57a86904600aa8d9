"""Siltstone: bronze / silver / gold table building on PySpark.

Every public function takes and returns DataFrames or Columns, so the work stays in one
logical plan per table and Catalyst picks the physical strategy.
"""
