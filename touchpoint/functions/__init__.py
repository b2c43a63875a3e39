"""Column functions: built-in Spark expressions only, no Python in the row path."""
