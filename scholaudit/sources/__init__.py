"""Reading, gating and writing versioned tables."""
