"""Indirect-tax return analytics as Spark jobs.

Every public function takes and returns DataFrames (or Columns) and stays lazy
unless its docstring says otherwise.
"""
