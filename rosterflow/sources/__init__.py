"""Readers; each returns a DataFrame over any number of files."""
