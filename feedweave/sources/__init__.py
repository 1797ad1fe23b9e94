"""Readers for landed feed files and the raw archive."""
