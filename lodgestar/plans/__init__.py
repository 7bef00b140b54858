"""Whole jobs: the three analyses and the warehouse load."""
