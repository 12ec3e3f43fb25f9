"""Layered analytics and table intelligence as plain Spark DataFrame jobs."""
