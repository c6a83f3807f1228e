"""The query registry (one callable per operator of the inventory), its DuckDB oracle
SQL, and plan inspection helpers."""
