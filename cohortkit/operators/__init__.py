"""Relational building blocks; each is DataFrame(s) -> DataFrame."""
