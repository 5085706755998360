"""Tessera: numbers, geometry and free text about the same places, joined on Spark.

Every public function takes and returns DataFrames (or Columns); nothing here
executes a plan except where the docstring says so.
"""
