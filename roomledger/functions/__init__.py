"""Column library: every function takes and returns Columns, nothing leaves the JVM."""
