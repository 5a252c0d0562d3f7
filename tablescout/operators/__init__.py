"""Profiling and join-discovery operators, each a lazy DataFrame plan."""
