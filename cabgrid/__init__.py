"""Taxi demand and charging analytics on a hexagonal grid, as Spark DataFrame operators."""

__version__ = "0.1.0"
