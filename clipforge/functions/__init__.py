"""Column-level functions (scalar expressions) and fixed values."""
