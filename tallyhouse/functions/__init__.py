"""Column expressions with the warehouse's own semantics."""
