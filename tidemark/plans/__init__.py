"""Whole jobs: several operators in one plan."""
