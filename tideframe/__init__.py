"""tideframe: market-data analytics and large-table maintenance, planned on Spark DataFrames."""

__version__ = "0.1.0"
