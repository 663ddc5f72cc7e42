"""Reading raw trips and reading or writing layer tables."""
