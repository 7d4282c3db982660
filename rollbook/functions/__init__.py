"""Column to Column functions; all stay inside the JVM."""
