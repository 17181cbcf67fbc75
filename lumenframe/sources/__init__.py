"""Readers, writers and interchange with Arrow, pandas and numpy."""
