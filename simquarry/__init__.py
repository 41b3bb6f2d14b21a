"""Spark operators for the data work behind a simulation repository.

Every operator takes DataFrames and returns DataFrames for all keys at once.
Clocks and seeds are parameters, so a result depends on its inputs only.
"""
