"""Batch generation of structured records on Spark."""
