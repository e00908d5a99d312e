"""Operators for cleaning and measuring text corpora.

Nothing outside this package imports it. Every operator takes a DataFrame with
an id column and a text column (other columns are ignored, so clashing names
are harmless) and documents what it does with nulls, empty tables and repeated
rows. ``registry`` holds the queries and their SQL.
"""
