"""A data lake of air arrivals, built and queried with Spark DataFrames."""

from landfall import functions, operators, plans, sinks, sources

__all__ = ["functions", "operators", "plans", "sinks", "sources"]
