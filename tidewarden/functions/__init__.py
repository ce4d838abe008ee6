"""Column functions: draws, feature vectors, scoring, formatting."""
