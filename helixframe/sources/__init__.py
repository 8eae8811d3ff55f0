"""Readers that turn annotation files into record DataFrames."""
