"""Grouped-membership analytics as Spark DataFrame operators.

Every operator is a function from DataFrames and parameters to a DataFrame; column names are
parameters, so the same operator serves gene tables and any other table with the same shape.
"""
