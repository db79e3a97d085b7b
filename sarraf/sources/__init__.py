"""Reading and writing."""
