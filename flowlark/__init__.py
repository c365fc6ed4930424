"""flowlark: record-flow analytics on Spark DataFrames and structured streams."""

__version__ = "0.1.0"
