"""Column builders. Every function takes and returns Columns and stays in the JVM."""
