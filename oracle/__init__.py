"""Independent SQL statements of every query, for the side-by-side check."""
