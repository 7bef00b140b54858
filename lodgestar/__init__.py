"""Rental review analytics as PySpark DataFrame jobs.

Raw listings, calendars and guest reviews become a small star schema (one fact table, four
dimensions) and three parameterised analyses. Every step is a ``DataFrame -> DataFrame`` function
made of built-in expressions, so Catalyst sees the whole plan.
"""
