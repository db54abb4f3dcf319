"""Change tracking and incremental loads on plain Spark DataFrames."""

__version__ = "0.1.0"
