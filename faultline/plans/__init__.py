"""Registered queries over the exception log."""
