"""Column expressions. Everything here stays inside the JVM; no Python UDFs."""
