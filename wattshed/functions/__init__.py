"""Column functions: text, numbers, dates, geography and heating rules."""
