"""Incremental content synchronisation and its analytics as Spark DataFrame functions."""
