"""Column expressions (all JVM-side: built-ins and higher-order functions)."""
