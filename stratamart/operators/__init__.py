"""Relational building blocks and the table-metadata jobs."""
