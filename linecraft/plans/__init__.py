"""Whole jobs (source → operators → sink) and the registered queries."""
