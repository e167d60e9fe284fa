"""Column expressions; all of them stay inside generated JVM code."""
