"""Layered sales data store on plain Spark DataFrames.

Raw CSV -> typed tables -> quality gates -> star schema -> reports, written
with built-in Spark operators only.
"""
