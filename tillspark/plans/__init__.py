"""Retail results as functions from DataFrames to a DataFrame.

Every function that depends on the day takes ``as_of``.
"""
