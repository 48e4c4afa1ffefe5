"""Column expressions: record envelope and object metadata."""
