"""Column functions: calendar arithmetic, scalars, quantiles."""
