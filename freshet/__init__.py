"""Freshet: a layered e-commerce warehouse as Spark DataFrame jobs.

Change logs and behaviour logs come in; dimension tables, fact tables and
windowed metrics go out.  Every transformation takes and returns a DataFrame
and runs on batch tables; the streaming package runs the same rules with
Structured Streaming.
"""
