"""Flow configuration and what is composed from it."""
