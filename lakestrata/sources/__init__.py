"""Reading sources, landing raw batches, versioned tables."""
