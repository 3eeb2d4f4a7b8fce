"""DuckDB SQL equivalents of the registered queries."""


def every_sql() -> dict[str, str]:
    from oracle.duckdb_sql import oracle_sql
    from oracle.periods_sql import periods_sql
    from oracle.stored_sql import stored_sql
    from oracle.streams_sql import streams_sql

    return oracle_sql() | stored_sql() | streams_sql() | periods_sql()
