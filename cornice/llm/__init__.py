"""Operators for preparing training data at corpus scale.

Nothing outside this subpackage imports it.  Every operator takes DataFrames
and returns DataFrames; `queries.py` binds each of them to the test tables.
"""
