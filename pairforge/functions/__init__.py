"""Column-level helpers (JVM-side Spark expressions unless stated)."""
