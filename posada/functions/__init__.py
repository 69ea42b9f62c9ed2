"""Column -> Column building blocks. Everything here is a built-in Spark expression."""
