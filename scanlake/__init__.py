"""scanlake: network-interference measurement analytics on Spark.

Operators are functions from DataFrames to a DataFrame; scalar functions are
functions from Columns to a Column. Nothing here collects data to the driver.
"""
