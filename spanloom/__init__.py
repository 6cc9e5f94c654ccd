"""Nested telemetry to typed tables, as Spark DataFrames."""
