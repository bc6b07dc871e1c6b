"""Readers and writers: JSON landing area, text files, CSV manifest, tables."""
