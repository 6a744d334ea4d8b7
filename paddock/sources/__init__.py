"""Reading, describing and writing tables."""
