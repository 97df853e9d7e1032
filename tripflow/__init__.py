"""Trip-record analytics on Spark DataFrames and Structured Streaming."""

from tripflow.session import init_spark

__all__ = ["init_spark"]
