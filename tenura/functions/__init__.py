"""Column functions: names, dates, rounding and rules."""
