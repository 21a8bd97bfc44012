"""Column expressions. Everything here takes and returns Columns and stays in the JVM."""
