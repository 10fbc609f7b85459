"""Column-level helpers: text and date cleaning, hashing."""
