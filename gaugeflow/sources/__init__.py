"""Readers of the stored tables and landed pages, and HTML extraction."""
