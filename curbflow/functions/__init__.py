"""Column expressions: text keys, times, numbers, geometry."""
