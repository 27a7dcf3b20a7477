"""Training-data operators: one module per operator, queries in ``queries.py``.

Every operator takes and returns DataFrames. Intermediate tables and files
(archives, token files) go to the shared folder named by
``spark.checkpoint.dir``; see :mod:`tallow.llm.common`.
"""
