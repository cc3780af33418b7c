"""Column functions: text in, text or numbers out, all built from native expressions."""
