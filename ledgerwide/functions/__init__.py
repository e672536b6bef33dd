"""Column expressions. Everything here stays JVM-side; there are no UDFs."""
