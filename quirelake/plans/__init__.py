"""Runs over a lake, and the registered queries."""
