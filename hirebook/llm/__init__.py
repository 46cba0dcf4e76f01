"""Operators of a training-data pipeline, each over a whole Spark table.

The package stands alone: nothing else in the library imports it.  Every
module holds one operator with a general interface; ``catalog.py`` holds the
thin registered queries.
"""
