"""Incremental table modelling on Spark DataFrames."""
