"""Column expressions: every function maps columns to a column and adds no job."""
