"""Column-level helpers and scalar distribution functions."""
