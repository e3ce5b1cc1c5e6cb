"""Readers: files, and the business filters of each input table."""
