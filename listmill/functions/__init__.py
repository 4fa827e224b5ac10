"""Column functions and row rules."""
