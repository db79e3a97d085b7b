"""Column-to-column functions; all run inside the JVM."""
