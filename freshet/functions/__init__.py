"""Column functions: time, money, maps and text."""
