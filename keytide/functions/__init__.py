"""Column expressions; all of them run inside generated JVM code."""
