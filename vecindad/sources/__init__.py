"""Readers for input files and stored tables."""
