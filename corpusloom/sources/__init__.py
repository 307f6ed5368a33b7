"""Readers that turn article files and label tables into DataFrames, and the writers for results."""
