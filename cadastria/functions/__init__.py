"""Column expressions shared by every table, so that keys and bands always agree."""
