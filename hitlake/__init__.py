"""Explore, export and report on large sets of log-like JSON documents with Spark."""
