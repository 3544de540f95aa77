"""Whole jobs: imports, monthly charges and reports."""
