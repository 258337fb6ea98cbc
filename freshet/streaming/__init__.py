"""Stateful operators, sinks and stream runs."""
