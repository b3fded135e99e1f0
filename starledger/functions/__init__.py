"""Column functions. All are built-in expressions, so they stay in generated code on the JVM."""
