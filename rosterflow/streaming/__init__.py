"""Structured Streaming intake of uploaded files."""
