"""Streams and tables the jobs read."""
