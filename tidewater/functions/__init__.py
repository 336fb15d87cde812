"""Column-level helpers (hashing, regex, time, type names)."""
