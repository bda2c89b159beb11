"""Every operator as a query on the test tables, with an independent SQL text for DuckDB."""
