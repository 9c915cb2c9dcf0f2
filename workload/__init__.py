"""Checked queries of the library over the test tables, and the same results as DuckDB SQL."""
