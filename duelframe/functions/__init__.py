"""Scalar column functions (JVM-side expressions, no Python UDFs)."""
