"""Text analytics and learning jobs on Spark DataFrames."""

__version__ = "0.1.0"
