"""Column-level functions: parsing, cleaning, time and IP helpers."""
