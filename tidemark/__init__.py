"""Daily and streaming ELT on lake tables, as plain functions over DataFrames.

functions   column expressions and naming rules
operators   transforms: columns, filters, joins, latest row per key, history
sources     files, JDBC, catalog tables and keyed tables (read and write)
plans       multi-step runs: zones and control table
streaming   the same steps driven by Structured Streaming
"""
