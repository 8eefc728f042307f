"""Column expressions: each takes columns and returns a column, and stays inside the JVM."""
