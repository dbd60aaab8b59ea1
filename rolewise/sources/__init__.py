"""Reading input tables and writing result tables."""
