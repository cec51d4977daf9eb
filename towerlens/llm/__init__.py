"""Operators of a training-data pipeline over whole tables of documents.

One module per operator; ``queries.py`` binds each to the production query
that ``__spark_entry__`` registers. Nothing outside this subpackage (and the
pipeline script at the repository top) imports it.
"""
