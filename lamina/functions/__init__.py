"""Column expressions: coercion, domains, geometry."""
