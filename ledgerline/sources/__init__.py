"""Readers for landed files and the stored layer tables."""
