"""Column expressions: cleansing, dates, arithmetic, keys and labels."""
