"""Column expressions: time handling and missing values."""
