"""Quality checks, cleaning and risk analysis of transaction tables on Spark.

Every operator takes and returns a DataFrame and stays lazy; the few functions
that run jobs themselves (sinks, ``full_run``, hash-based duplicate counting)
say so in their docstring.
"""
