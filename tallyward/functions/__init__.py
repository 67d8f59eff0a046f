"""Column functions: text, numbers, dates, names."""
