"""Conform: clean, standardise, protect and load tables with Spark.

Every operator takes DataFrames and returns a DataFrame, so a pipeline is one
lazy plan until a sink runs it.
"""
