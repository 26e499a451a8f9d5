"""The registered queries: on Spark (``spark_queries``) and, apart from it, as DuckDB
SQL over the same sample tables (``duckdb_queries``)."""
