"""Whole queries: the operators put together, and their binding to test tables."""
