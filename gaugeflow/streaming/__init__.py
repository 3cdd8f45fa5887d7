"""Structured Streaming variants of the update and the marts."""
