"""Shared plan shapes (blocked prefix scan, salted lookup) and the query catalog."""
