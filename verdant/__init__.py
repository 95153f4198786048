"""verdant: clickstream and points analytics as Spark DataFrame jobs.

Every operator is a function from DataFrames (plus parameters) to a
DataFrame; sources and sinks are passed in, so batch runs, Structured
Streaming and tests share one code path.
"""

__version__ = "0.1.0"
