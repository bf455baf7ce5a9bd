"""cohort: consent-aware identity resolution and audience analytics on Spark.

Every operator takes DataFrames and returns DataFrames; nothing here creates a
session or triggers an action except the iterative graph operator and model
fits, which must.
"""

__version__ = "0.1.0"
