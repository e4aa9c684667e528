"""kinloom: a single view of a person from messy multi-source records, on Spark.

Every operator takes DataFrames and parameters and returns DataFrames.  None of
them reads the wall clock or draws random numbers; time enters as ``as_of``.
"""
