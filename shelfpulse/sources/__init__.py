"""Reading and writing the stored tables."""
