"""Fund screening, measuring and ranking on Spark DataFrames.

Every operator is a pure function from DataFrames to DataFrames; nothing runs
until the caller acts on a result.  ``as_of`` is a mandatory parameter wherever
rows carry dates, so that no operator can see the future.
"""
