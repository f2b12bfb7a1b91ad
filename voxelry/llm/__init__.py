"""Operators of a training-data pipeline. Nothing outside this subpackage imports it (but for the guarded driver entry).

Every operator takes and returns DataFrames, keeps the columns it does not define, and reserves the prefix ``_llm_`` for
its own helper columns: an input column of that prefix is refused, any other name may occur.
"""
