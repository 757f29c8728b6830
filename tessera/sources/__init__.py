"""Readers of the source dumps and writers of the results."""
