"""Training-data operators (token files, near-duplicates, contamination, packing, scoring).

Every operator takes DataFrames and returns a DataFrame; the registered queries
and their SQL are in ``parcelspark.llm.queries``.  Nothing outside this
subpackage imports it.
"""
