"""Whole runs, and the queries with their SQL counterparts."""
