"""Column expressions (all JVM-side, no UDF)."""
