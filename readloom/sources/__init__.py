"""Readers of the text formats."""
