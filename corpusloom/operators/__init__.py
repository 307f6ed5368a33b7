"""Relational, feature and model jobs. Each takes DataFrames and returns DataFrames."""
