"""Column functions: formatting, text cleansing and validation rules."""
