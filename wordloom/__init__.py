"""wordloom: text-analytics, evaluation and telemetry operators on Spark DataFrames.

Every operator takes DataFrames and returns a DataFrame; nothing is
collected inside an operator, and planning is left to Catalyst.
"""

__version__ = "0.1.0"
