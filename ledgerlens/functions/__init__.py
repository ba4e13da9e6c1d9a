"""Column expressions. Nothing here starts a job or moves a row."""
