"""Column expressions and driver-side argument helpers."""
