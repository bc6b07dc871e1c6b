"""Continuous counterparts of the batch jobs; both share the same transforms."""
