"""Relational operators over observation histories, as functions from DataFrames to DataFrames."""
