"""DuckDB SQL giving the expected result of every registered query."""
