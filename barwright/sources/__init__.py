"""Readers of raw files and the tables they are loaded into."""
