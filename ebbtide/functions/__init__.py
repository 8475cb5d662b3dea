"""Column expressions: everything here is a built-in Spark expression tree, no Python per row."""
