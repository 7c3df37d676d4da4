"""runledger: batch ETL and run evidence on Spark DataFrames."""

__version__ = "0.1.0"
