"""Clickstream analytics as Spark DataFrame jobs.

``functions``  Column -> Column: text clean-up, timestamps, event category, keys
``sources``    CSV drops, request bodies, topic messages, table scans
``operators``  DataFrame -> DataFrame: normalise, validate, keyed state, metrics
``plans``      batch jobs that chain the operators and write tables
``streaming``  Structured Streaming versions of the ingest jobs
"""
