"""Operators for preparing language-model training data.

One module per operator; each takes DataFrames, returns DataFrames and keeps
its own general interface. ``queries`` holds the thin registered queries.
"""
