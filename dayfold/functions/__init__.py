"""Column expressions. All are built-ins: no Python runs per row."""
