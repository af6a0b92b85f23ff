"""Column expressions shared by all plans; everything is a built-in Spark expression."""
