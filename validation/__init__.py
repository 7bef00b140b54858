"""Checks of the package on the given tables: input frames, Spark queries and their plain SQL."""
