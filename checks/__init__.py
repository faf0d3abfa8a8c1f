"""Registered queries and the DuckDB SQL each must agree with."""
