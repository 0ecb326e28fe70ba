"""DuckDB SQL that states the expected result of every query, written apart from the Spark code."""
