"""Reading extracts, writing tables, and the tables that carry test data."""
