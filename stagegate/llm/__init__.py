"""Operators for building training corpora: one module per operator, their registered queries in ``queries``.

Nothing outside this subpackage imports it.  Every operator takes DataFrames and
column names, works on whole texts and leaves partitioning, shuffles and retries
to Spark; numpy, Arrow and the tokenizer libraries run inside tasks only.
"""
