"""Reading, writing, catalog work and intermediate tables."""
