"""Registered queries, and independent SQL for each on the same tables."""
