"""Operators of a training-data pipeline: one module each, plus their queries and SQL.

Nothing outside this package imports it. Every operator takes and returns DataFrames; a row is
known by ``row_key`` (two hashes of id and text), so null ids, repeated rows and repeated ids with
other texts never mix.
"""
