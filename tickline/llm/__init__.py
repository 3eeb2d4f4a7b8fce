"""Training-data operators: filtering, deduplication, archives and tokens.

Nothing outside this folder, ``corpus_pipeline.py`` and the driver's entry
module imports it. Operators take and return DataFrames; ``queries`` holds the
thin registered queries and ``oracle`` their DuckDB SQL.
"""
