"""bitloom: association analysis over binary presence/absence matrices on Spark.

Every public operator takes DataFrames and returns a DataFrame; nothing is
executed until the caller acts, except where a docstring says that a stage is
materialised in the shared checkpoint folder.
"""
