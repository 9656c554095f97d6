"""Whole loads put together from sources, operators and sinks."""
