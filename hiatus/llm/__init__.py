"""Operators for preparing large text corpora.

Every operator takes and returns DataFrames. ``queries`` applies each of them to
the test tables, ``oracles`` has SQL for those that SQL can express. Nothing else
in the library imports this package.
"""
