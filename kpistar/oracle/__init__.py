"""Correctness oracle: DuckDB SQL written independently of the DataFrame code."""
