"""Column expressions (JVM-side) and the few Arrow-batched Python helpers."""
