"""Column -> Column building blocks; everything stays in the JVM."""
