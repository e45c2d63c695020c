"""Warehouse build and the catalogue of analytic queries.

Every query is ``q(tables, **params) -> DataFrame`` over a mapping of table names to DataFrames.
Counts in the results end in a unique order, so top lists are repeatable.
"""
