"""Data that arrives day by day."""
