"""The expected result of every registered query, as DuckDB SQL."""
