"""Column functions: parsing and scalar rules."""
