"""sluice: landing records from partitioned logs into typed tables, and live
analytics over them, written with Spark DataFrames and Structured Streaming."""

__version__ = "0.1.0"
