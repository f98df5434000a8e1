"""Registered queries: operators bound to tables, each with DuckDB SQL where SQL expresses it."""
