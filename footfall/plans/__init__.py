"""Batch jobs. Each takes paths and one ``as_of`` time and can be run again without harm."""
