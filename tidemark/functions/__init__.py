"""Column functions: time windows, values, registry look-ups."""
