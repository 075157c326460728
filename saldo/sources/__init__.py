"""Readers and writers: CSV, the sales table, the star-schema mapping."""
