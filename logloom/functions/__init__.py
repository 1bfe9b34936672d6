"""Column expressions: log formats, converters, partition keys."""
