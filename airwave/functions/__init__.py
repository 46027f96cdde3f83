"""Column expressions. Every one stays inside the JVM; the engine has no Python UDF."""
