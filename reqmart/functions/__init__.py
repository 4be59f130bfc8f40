"""Column expressions: everything here stays inside Catalyst, no Python runs per row."""
