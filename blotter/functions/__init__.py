"""Column expressions. Every one runs on the JVM; none calls Python per row."""
