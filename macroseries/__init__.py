"""macroseries: macroeconomic time-series panels on Spark DataFrames."""

__version__ = "0.1.0"
