"""Operators: each takes and returns DataFrames; no actions, no driver rows."""
