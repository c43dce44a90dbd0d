"""Column expressions: everything here stays in generated JVM code."""
