"""Reading and writing tables."""
