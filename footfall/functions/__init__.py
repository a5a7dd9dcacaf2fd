"""Column expressions. Everything here is a built-in of the JVM side; there is no Python UDF."""
