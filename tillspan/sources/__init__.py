"""Table schemas, constraints, readers and writers."""
