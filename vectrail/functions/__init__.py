"""Column functions over vectors, text and search queries."""
