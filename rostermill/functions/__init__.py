"""Column expressions: scalars and arrays. All JVM-side, no UDF."""
