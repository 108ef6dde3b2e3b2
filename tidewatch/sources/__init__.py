"""Readers of landed files and tables, and writers."""
