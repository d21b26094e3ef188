"""Registered queries with the DuckDB SQL that must give the same rows."""
