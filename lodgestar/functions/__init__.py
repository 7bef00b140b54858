"""Column expressions: parsing of raw fields and the review rating."""
