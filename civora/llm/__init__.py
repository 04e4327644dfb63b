"""Training-data operators: one module per operator, queries in ``queries.py``.

Nothing else in the library imports this subpackage. Every operator takes and
returns DataFrames, keeps no state on the driver beyond bounded parameters,
and writes intermediate tables only below ``spark.checkpoint.dir``.
"""
