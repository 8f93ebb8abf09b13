"""Column functions and label ladders."""
